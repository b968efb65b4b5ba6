"""Near-duplicate documents by SetSketch registers.

A document is the set of its word shingles (five words by default). A SetSketch keeps, for each
of 180 hash functions, the smallest exponentially distributed hash over the set, truncated to a
step of a geometric scale (base 1.001); the registers of a union are the registerwise maxima. Some
registers form a band (five at similarity 0.8, six at 0.85); documents that agree in a band are
candidates. A pair's similarity is then estimated from
all registers by maximum likelihood, given both set sizes, and pairs that are not clearly below
the threshold are verified on their full sets.

Documents with the same word sequence are one class from the start (by a 128-bit digest of its
bytes). Sets are compared by hashes first; a link also needs the words themselves (`alike`). Within a bucket no pairs
are listed: members are tested against one pivot, links are contracted to components, and a
bucket stays open only while it holds different components. After three pivots, what is still
open is tested in blocks: all pairs of a bucket's members with those outside its largest
component, by matrix products of bounded size that return only connecting links. So a bucket of
mutual copies costs one test per member, and no link that a band shows is lost.

Defined cases: null, empty and white-space texts have no shingles, link with nothing and are
their own component; texts with fewer words than a shingle are one; the
smallest id ignores nulls, a component without any id has a null component_id, and a row with a
null id is never `kept`; rows that repeat an id are separate members with the same id; other
columns are not read. `keep_one` decides row by row, whatever the ids: one row of each component
stays, that with the smallest id, a null id last, and of rows with this id the first one read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retain.llm.common import attach, materialize, small_batches
from retain.llm.words import SPACED, Words, mixed, seeds, text_bytes, word_runs

SHINGLE, PERCENT = 5, 80  # words of a shingle, least similarity
REGISTERS = 180
MISS = 2e-6  # chance that a pair at the threshold shares no band, at most
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 2
SLACK = 5.0  # standard errors below the threshold at which an estimate is ruled out
PIVOT_ROUNDS = 3
BLOCK_ROWS, BLOCK_WORDS = 512, 200_000  # of a bucket's members that a task holds of either side
COLUMNS = 4096
RUN_BYTES = 512 << 10  # of texts that a worker sketches at once

_MULTIPLY = seeds(REGISTERS, 77) | np.uint64(1)
SKETCH = "digest binary, n bigint, registers binary"


def band_rows(percent: int) -> int:
    """Registers of a band: as many as the allowed miss lets be, as wider bands have fewer candidates."""
    for rows in range(REGISTERS, 1, -1):
        if (1 - (percent / 100) ** rows) ** (REGISTERS // rows) <= MISS:
            return rows
    return 1


# Sets and sketches of single documents --------------------------------------------------


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts' sets of shingle hashes, one after the other, and the n + 1 offsets."""
    h, sets = words.hashes, []
    if len(h) >= size:
        whole = h[: len(h) - size + 1].copy()
        for k in range(1, size):
            whole = mixed(whole) + h[k : len(h) - size + 1 + k]
        whole = mixed(whole)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= size:
            sets.append(np.unique(whole[a : b - size + 1]))
        elif b > a:
            few = np.uint64(b - a)
            for k in range(a, b):
                few = mixed(few + h[k])
            sets.append(np.atleast_1d(few))
        else:
            sets.append(np.zeros(0, np.uint64))
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), offsets


def registers(elements: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The SetSketch of each non-empty set, as rows of 16-bit registers."""
    starts = offsets[:-1][np.diff(offsets) > 0]
    out = np.empty((len(starts), REGISTERS), np.uint16)
    if not len(starts):
        return out
    step = np.empty_like(elements)
    for j in range(REGISTERS):
        np.multiply(elements, _MULTIPLY[j], out=step)
        least = np.minimum.reduceat(step, starts)
        h = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
        out[:, j] = np.clip(np.floor(1 - np.log(h) / np.log(BASE)), 0, TOP + 1)
    return out


def merged(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The registers of the union of two sets."""
    return np.maximum(left, right)


def estimate(n_left: np.ndarray, n_right: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Similarity of pairs of sets by joint maximum likelihood.

    With u, v the sets' shares of n_left + n_right, a register of the left is larger with
    probability p(u - vJ), of the right with p(v - uJ), where p(x) = -log_b(1 - x (b-1)/b).
    The likelihood of J is concave; golden-section search finds its maximum.
    """
    total = (n_left + n_right).astype(float)
    u, v = n_left / total, n_right / total
    more, less = (left > right).sum(1), (left < right).sum(1)
    same = left.shape[1] - more - less

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def fit(j):
        a, b = p(u - v * j), p(v - u * j)
        tiny = 1e-300
        return more * np.log(a + tiny) + less * np.log(b + tiny) + same * np.log(np.maximum(1 - a - b, tiny))

    ratio = (5**0.5 - 1) / 2
    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(30):
        c, d = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        right_half = fit(c) < fit(d)
        lo, hi = np.where(right_half, c, lo), np.where(right_half, hi, d)
    return (lo + hi) / 2


# Columns --------------------------------------------------------------------------------


def sketch(text: Column, size: int) -> Column:
    """Digest of the word sequence, number of shingles and registers (null without words)."""

    def make(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for words in word_runs(texts, SPACED, RUN_BYTES):
                elements, offsets = shingle_sets(words, size)
                n = np.diff(offsets)
                rows = iter(registers(elements, offsets))
                packed = [next(rows).astype(">u2").tobytes() if k else None for k in n]
                yield pa.StructArray.from_arrays(
                    [pa.array(digests_of(words), pa.binary()), pa.array(n, pa.int64()), pa.array(packed, pa.binary())],
                    ["digest", "n", "registers"],
                )

    return F.arrow_udf(make, SKETCH)(text)


def digests_of(words: Words) -> list[bytes]:
    """128-bit digests of the texts' lower-cased words, a space after each."""
    letters, offsets = words.letters()
    joined = np.insert(letters, offsets[1:], 0x20)
    bounds = (offsets[words.first] + words.first).tolist()
    return [hashlib.blake2b(joined[a:b].tobytes(), digest_size=16).digest() for a, b in zip(bounds, bounds[1:])]


def band_keys(registers: Column, rows: int) -> Column:
    width = 2 * rows
    return F.transform(
        F.sequence(F.lit(0), F.lit(REGISTERS // rows - 1)),
        lambda i: F.xxhash64(i, registers.substr(i * F.lit(width) + F.lit(1), F.lit(width))),
    )


def plausible(percent: int) -> Column:
    """Whether the estimate for two sketches is not clearly below the threshold."""
    goal = percent / 100
    floor = goal - SLACK * (goal * (1 - goal) / REGISTERS) ** 0.5

    @F.arrow_udf("boolean")
    def test(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for n_a, n_b, a, b in batches:
            rows = [np.frombuffer(b"".join(x.to_pylist()), ">u2").reshape(-1, REGISTERS) for x in (a, b)]
            yield pa.array(estimate(n_a.to_numpy(), n_b.to_numpy(), *rows) >= floor, pa.bool_())

    return test


def alike(left: pa.Array, right: pa.Array, percent: int, size: int) -> bool:
    """Whether two texts, each an array of one, reach the threshold on their full sets of shingles.

    Words are told apart by their bytes and shingles by their words; no hash decides.
    """
    words = Words(*text_bytes(pa.concat_arrays([left, right])), SPACED)
    letters, offsets = words.letters()
    held = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    word = held.dictionary_encode().indices.to_numpy().astype(np.int64)
    a, b = words.counts.tolist()
    if min(a, b) < size:  # a short text is one shingle
        return a == b > 0 and bool((word[:a] == word[a:]).all())
    last, n = len(word) - size + 1, int(word.max()) + 1
    shingle = word[:last]
    for k in range(1, size):
        shingle = np.unique(shingle * n + word[k : k + last], return_inverse=True)[1]
    x, y = np.unique(shingle[: a - size + 1]), np.unique(shingle[a:])
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)


def similar(percent: int, size: int):
    """Whether two texts' full sets reach the threshold: by hashes, and if so by their words."""

    @F.arrow_udf("boolean")
    def test(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            out = []
            for at in range(0, len(left), 64):
                sets = []
                for side in (left, right):
                    for words in word_runs(side.slice(at, 64), SPACED):
                        elements, offsets = shingle_sets(words, size)
                        sets += np.split(elements, offsets[1:-1])
                half = len(sets) // 2
                for i, (x, y) in enumerate(zip(sets[:half], sets[half:]), at):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    near = bool(both) and 100 * both >= percent * (len(x) + len(y) - both)
                    out.append(near and alike(left.slice(i, 1), right.slice(i, 1), percent, size))
            yield pa.array(out, pa.bool_())

    return test


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each left set shares with each right set, by products of 0/1 matrices."""
    both = np.intersect1d(np.concatenate(left), np.concatenate(right))
    out = np.zeros((len(left), len(right)), np.float32)
    sides = []
    for sets in (left, right):
        row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        value = np.concatenate(sets)
        column = np.searchsorted(both, value)
        held = both[np.minimum(column, len(both) - 1)] == value if len(both) else np.zeros(len(value), bool)
        order = np.argsort(column[held], kind="stable")
        sides.append((row[held][order], column[held][order], len(sets)))
    for at in range(0, len(both), COLUMNS):
        parts = []
        for row, column, n in sides:
            a, b = np.searchsorted(column, [at, at + COLUMNS])
            part = np.zeros((n, min(COLUMNS, len(both) - at)), np.float32)
            part[row[a:b], column[a:b] - at] = 1
            parts.append(part)
        out += parts[0] @ parts[1].T
    return out


def linked_rows(percent: int, size: int):
    """A function for the rows of two blocks: links between rows of different components."""

    def test(block: pa.Table) -> pa.Table:
        few = np.array(block.column("few").to_pylist(), bool)
        cls, comp = block.column("cls").to_numpy(), block.column("comp").to_numpy()
        sets, texts = [], block.column("text").combine_chunks()
        for words in word_runs(texts, SPACED):
            elements, offsets = shingle_sets(words, size)
            sets += np.split(elements, offsets[1:-1])
        links, root = [], {}

        def top(x):
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        x, y = np.flatnonzero(few), np.flatnonzero(~few)
        if len(x) and len(y):
            held = np.array([len(s) for s in sets])
            both = common_counts([sets[i] for i in x], [sets[i] for i in y])
            either = held[x][:, None] + held[y][None, :] - both
            similar = (both > 0) & (100 * both.astype(np.float64) >= percent * either) & (comp[x][:, None] != comp[y][None, :])
            for i, j in zip(*np.nonzero(similar)):
                a, b = top(int(comp[x[i]])), top(int(comp[y[j]]))
                if a != b and alike(texts.slice(x[i], 1), texts.slice(y[j], 1), percent, size):
                    root[a] = b
                    links.append((int(cls[x[i]]), int(cls[y[j]])))
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return test


# Links and components -------------------------------------------------------------------


class Finder:
    """The tables of one run: classes, buckets and the texts that tests read."""

    def __init__(self, docs: DataFrame, percent: int, size: int, others: list[Column] | None = None):
        """`others` are further columns, kept in the struct `others` of each row."""
        self.percent, self.size = percent, size
        held = [F.struct(*others).alias("others")] if others else []
        made = docs.select("doc_id", "text", sketch(F.col("text"), size).alias("s"), F.monotonically_increasing_id().alias("row"), *held)
        with small_batches(docs.sparkSession):
            self.rows = materialize(made.select("row", "doc_id", "text", "s.digest", "s.n", "s.registers", *["others"] * len(held)), "sketches")
        # A class is called by one of its rows, whose text stands for it.
        grouped = self.rows.groupBy("digest").agg(
            F.min("row").alias("cls"), F.min("doc_id").alias("first_id"), F.max("n").alias("n"),
            F.max("registers").alias("registers"), F.count(F.lit(1)).alias("copies"),
        )
        self.classes = materialize(grouped, "classes")
        self.members = materialize(self.bucketed(), "members")
        candidates = self.members.select(F.col("cls").alias("row")).distinct()
        texts = self.rows.select("row", "text").join(candidates, "row")
        self.texts = materialize(texts.withColumnRenamed("row", "cls"), "texts")

    def bucketed(self) -> DataFrame:
        """(key, cls, n) of all buckets with more than one class."""
        bands = self.classes.filter("n > 0").select("cls", "n", F.explode(band_keys(F.col("registers"), band_rows(self.percent))).alias("key"))
        shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
        return bands.join(shared.select("key"), "key")

    def links(self, pairs: DataFrame, label: str) -> DataFrame:
        """The pairs (a, b) whose full sets are similar. `pairs` has each pair once at most."""
        sides = self.classes.select("cls", "n", "registers")
        for side in "ab":
            pairs = pairs.join(sides.select(*[F.col(c).alias(f"{c}_{side}") for c in sides.columns]).withColumnRenamed(f"cls_{side}", side), side)
        fits = F.lit(100) * F.least("n_a", "n_b") >= F.lit(self.percent) * F.greatest("n_a", "n_b")
        close = materialize(
            pairs.filter(fits).filter(plausible(self.percent)("n_a", "n_b", "registers_a", "registers_b")).select("a", "b"),
            f"{label}-plausible",
        )
        for side in "ab":
            close = close.join(self.texts.select(F.col("cls").alias(side), F.col("text").alias(f"text_{side}")), side)
        with small_batches(close.sparkSession):
            return materialize(close.filter(similar(self.percent, self.size)("text_a", "text_b")).select("a", "b"), f"{label}-links")

    def components(self) -> DataFrame:
        """(cls, comp) of all classes that share a bucket.

        In a round every open bucket tests one pivot against its members of other components.
        Then all pairs with the pivot are known and it leaves the bucket; a bucket is open
        while it holds more than one component.
        """
        nodes = self.members.select("cls").distinct()
        comp = materialize(nodes.withColumn("comp", F.col("cls")), "comp")
        order = [F.col("cls"), -F.col("cls"), F.xxhash64("cls")]
        open_ = materialize(unresolved(self.members, comp), "open")
        for turn in range(PIVOT_ROUNDS):
            if open_.isEmpty():
                return comp
            pivots = open_.groupBy("key").agg(F.min(F.struct(order[turn].alias("by"), "cls", "comp")).alias("p"))
            seen = open_.join(pivots, "key").filter(F.col("cls") != F.col("p.cls"))
            pairs = seen.filter(F.col("comp") != F.col("p.comp")).select(
                F.least("cls", "p.cls").alias("a"), F.greatest("cls", "p.cls").alias("b")
            )
            comp = self.joined(comp, self.links(pairs.distinct(), f"pivot{turn}"))
            open_ = materialize(unresolved(seen.select("key", "cls", "n"), comp), "open")
        return comp if open_.isEmpty() else self.joined(comp, self.rest(open_))

    def rest(self, open_: DataFrame) -> DataFrame:
        """Links that connect the components of what is still open, by testing all its pairs.

        Every pair of different components has a side outside the bucket's largest one. Those
        members are dealt into blocks, and all members too; a task tests one block against
        another, both of bounded size, and returns no more links than connect its rows.
        """
        per = open_.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("held"), F.sum("n").alias("words"))
        buckets = per.groupBy("key").agg(
            F.max(F.struct("held", "comp"))["comp"].alias("largest"),
            F.greatest(F.ceil(F.sum("held") / BLOCK_ROWS), F.ceil(F.sum("words") / BLOCK_WORDS)).cast("int").alias("blocks"),
        )
        placed = open_.join(buckets, "key").withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
        every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        few = placed.filter("comp != largest").select("key", "cls", "comp", F.lit(True).alias("few"), F.col("own").alias("i"), every.alias("j"))
        all_ = placed.select("key", "cls", "comp", F.lit(False).alias("few"), every.alias("i"), F.col("own").alias("j"))
        blocks = few.unionByName(all_).join(self.texts, "cls")
        return blocks.groupBy("key", "i", "j").applyInArrow(linked_rows(self.percent, self.size), "a long, b long")

    def joined(self, comp: DataFrame, links: DataFrame) -> DataFrame:
        """The components with the links (a, b) added."""
        ends = comp.select(F.col("cls").alias("a"), F.col("comp").alias("x"))
        edges = links.join(ends, "a").join(ends.toDF("b", "y"), "b").select("x", "y")
        return materialize(relabel(comp, "comp", contract(edges)), "comp")


def unresolved(members: DataFrame, comp: DataFrame) -> DataFrame:
    """(key, cls, n, comp) of the buckets that hold more than one component."""
    placed = members.join(comp, "cls")
    split = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo != hi")
    return placed.join(split.select("key"), "key")


def relabel(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """`column` replaced by the mapping (node, root) where that has it."""
    moved = df.join(mapping.select(F.col("node").alias(column), F.col("root").alias("_root")), column, "left")
    return moved.withColumn(column, F.coalesce("_root", column)).select(*df.columns)


def contract(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (x, y); root is the least node it is connected to.

    Each round maps a node to its least neighbour and that one's least neighbour, then merges
    mapped nodes; the number of nodes at least halves.
    """
    edges = materialize(edges.filter("x != y").distinct(), "edges")
    roots = edges.select(F.explode(F.array("x", "y")).alias("node")).distinct().withColumn("root", F.col("node"))
    while not edges.isEmpty():
        both = edges.union(edges.select("y", "x"))
        least = both.groupBy("x").agg(F.min("y").alias("y")).select(F.col("x").alias("node"), F.least("x", "y").alias("root"))
        jump = materialize(relabel(least, "root", least), "jump")
        roots = relabel(roots, "root", jump)
        edges = materialize(relabel(relabel(edges, "x", jump), "y", jump).filter("x != y").distinct(), "edges")
    return roots


def near_duplicates(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of `docs`."""
    finder = Finder(docs, percent, size)
    comp = finder.components()
    linked = finder.classes.join(comp, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    least = linked.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    labels = materialize(linked.join(least, "comp").select("digest", "component_id", "copies"), "labels")
    rows = attach(
        finder.rows.select("row", "doc_id", "n", "digest"), labels, "digest", "copies", F.xxhash64("row"),
    )
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
    )


def keep_one(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """One row of each component of `docs`, and every row without shingles; columns unchanged."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    finder = Finder(docs, percent, size, [F.col(f"`{c}`") for c in others])
    comp = finder.components()
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    firsts = finder.rows.filter("n > 0").groupBy("digest").agg(F.min(order).alias("first"))
    linked = finder.classes.select("cls", "digest").join(comp, "cls", "left").join(firsts, "digest")
    chosen = linked.groupBy(F.coalesce("comp", "cls").alias("comp")).agg(F.min("first").alias("first")).select("first.row")
    left = finder.rows.join(chosen.union(finder.rows.filter("n = 0").select("row")), "row", "left_semi")
    return left.select(*[F.col(f"others.`{c}`") if c in others else F.col(c) for c in docs.columns])
