"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of ten words of each benchmark item, or the whole of a shorter one.
Per pattern length, a block of two words ending at the cursor is looked up in a shift table:
a block that no pattern holds moves the cursor by a whole pattern less one, others by their
least distance from a pattern's end. Where the shift is 0 the block's bucket names the patterns
that end in it; these are compared word by word, by hash and then by their bytes.

Cursors of many stretches of text advance together, one numpy step for all. Spark cuts the
benchmark into its distinct windows, each with the ids of its items, and deals them to blocks of
bounded bytes, which tasks write to files in the shared folder. The driver has the files' names. A
worker loads one block, searches some MB of text for it, and lets it go for the next, so no table
grows with either side; only the ids of one window, like those of one document, are a list.

Defined cases: null and empty texts have no words and no hits; items without words, and items
with a null text, have no windows; repeated items and ids all count by their item_id; items with a
null id hit like others and count as one item together, which the digest of ids leaves out; an
empty benchmark marks nothing; any other column is left alone.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retain.llm.common import materialize, shared_path
from retain.llm.words import ALNUM, Words, mixed, word_runs

WINDOW = 10
BLOCK_BYTES = 8 << 20  # windows and ids in one block
HELD_RUNS = 8  # runs of text, about 2 MB each, that are searched for a block before the next is loaded
CUT_ROWS = 10_000
STRETCH = 256  # words that one cursor scans

RESULT = "n_words bigint, n_hit bigint, items array<string>"
CUT = pa.schema([("length", pa.int32()), ("pattern", pa.binary()), ("item_id", pa.string())])


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mixed(left * np.uint64(0x9E3779B97F4A7C15) + right)


class Table:
    """Shift table and suffix buckets for patterns of one length."""

    def __init__(self, length: int, patterns: pa.Array, hashes: np.ndarray, items: pa.Array):
        self.length, self.patterns, self.hashes, self.items = length, patterns, hashes, items
        self.block = min(2, length)
        size = 1 << max(12, (16 * hashes.size).bit_length())
        self.mask = np.uint64(size - 1)
        self.shift = np.full(size, length - self.block + 1, np.int32)
        for end in range(self.block - 1, length):
            np.minimum.at(self.shift, self.slot(hashes, end), length - 1 - end)
        last = self.slot(hashes, length - 1)
        self.order = np.argsort(last, kind="stable")
        self.bucket = np.searchsorted(last[self.order], np.arange(size + 1))

    def slot(self, hashes: np.ndarray, end: int) -> np.ndarray:
        key = hashes[:, end] if self.block == 1 else _pair(hashes[:, end - 1], hashes[:, end])
        return (key & self.mask).astype(np.int64)

    def scan(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(last word, pattern) of every occurrence."""
        h, length = words.hashes, self.length
        doc = np.flatnonzero(words.counts >= length)
        stretches = -(-(words.counts[doc] - length + 1) // STRETCH)
        nth = np.arange(stretches.sum()) - np.repeat(np.cumsum(stretches) - stretches, stretches)
        cursor = np.repeat(words.first[doc], stretches) + nth * STRETCH + length - 1
        stop = np.minimum(cursor + STRETCH, np.repeat(words.first[doc + 1], stretches))
        found = []
        while cursor.size:
            key = h[cursor] if self.block == 1 else _pair(h[cursor - 1], h[cursor])
            slot = (key & self.mask).astype(np.int64)
            shift = self.shift[slot]
            at = np.flatnonzero(shift == 0)
            if at.size:
                found.append(self.compare(words, cursor[at], slot[at]))
            cursor = cursor + np.maximum(shift, 1)
            alive = cursor < stop
            cursor, stop = cursor[alive], stop[alive]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def compare(self, words: Words, cursor: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin, n = self.bucket[slot], self.bucket[slot + 1] - self.bucket[slot]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        pattern = self.order[np.repeat(begin, n) + nth]
        last = np.repeat(cursor, n)
        for back in range(self.length):
            same = words.hashes[last - back] == self.hashes[pattern, self.length - 1 - back]
            last, pattern = last[same], pattern[same]
        exact = [
            b" ".join(words.bytes_of(e - self.length + 1 + k) for k in range(self.length)) == self.patterns[p].as_py()
            for e, p in zip(last.tolist(), pattern.tolist())
        ]
        exact = np.array(exact, bool)
        return last[exact], pattern[exact]


def in_order(ids: set[str | None]) -> list[str | None]:
    """The ids by code points, null last."""
    return sorted(ids, key=lambda i: (i is None, i or ""))


class Hits:
    """What occurs in a run of texts, gathered block by block."""

    def __init__(self, words: Words):
        self.words = words
        self.edges = np.zeros(len(words.hashes) + 1, np.int64)
        self.items: list[set[str | None]] = [set() for _ in words.counts]

    def add(self, tables: list[Table]) -> None:
        for table in tables:
            last, pattern = table.scan(self.words)
            np.add.at(self.edges, last - table.length + 1, 1)
            np.add.at(self.edges, last + 1, -1)
            for d, p in zip((np.searchsorted(self.words.first, last, "right") - 1).tolist(), pattern.tolist()):
                self.items[d].update(table.items[p].as_py())

    def result(self) -> tuple[np.ndarray, list[list[str | None]]]:
        """Hit words and sorted item ids of each text."""
        covered = np.concatenate([[0], np.cumsum(np.cumsum(self.edges[:-1]) > 0)])
        return covered[self.words.first[1:]] - covered[self.words.first[:-1]], [in_order(s) for s in self.items]


# Patterns -------------------------------------------------------------------------------


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(length, pattern, items): every distinct window, its words joined by spaces, with all ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows):
            columns = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, CUT)], schema=CUT)

        for batch in batches:
            ids, rows = iter(batch.column(0).to_pylist()), []
            for words in word_runs(batch.column(1), ALNUM):
                for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
                    item_id, length = next(ids), min(window, b - a)
                    spelled = [words.bytes_of(i) for i in range(a, b)]
                    for i in range(b - a - length + 1 if length else 0):
                        rows.append((length, b" ".join(spelled[i : i + length]), item_id))
                        if len(rows) == CUT_ROWS:
                            yield batch_of(rows)
                            rows = []
            if rows:
                yield batch_of(rows)

    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").filter("text is not null")
    ids = F.sort_array(F.collect_set(F.struct("item_id")))  # in a struct, where a null id counts
    return items.mapInArrow(cut, "length int, pattern binary, item_id string").groupBy("length", "pattern").agg(
        F.transform(ids, lambda s: s["item_id"]).alias("items")
    )


def pattern_blocks(benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> list[str]:
    """Files in the shared folder with about `block_bytes` of patterns and ids each, dealt by a hash."""
    spark = benchmark.sparkSession
    found = materialize(windows(benchmark, window), "windows")
    total = found.agg(F.sum(F.octet_length("pattern") + F.octet_length(F.concat_ws(",", "items")))).first()[0] or 0
    part = F.pmod(F.xxhash64("pattern"), F.lit(max(1, -(-total // block_bytes))))
    folder = shared_path(spark, "patterns").rstrip("/")

    def put(block: pa.Table) -> pa.Table:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.arrow"
        with store.open_output_stream(f"{root}/{name}", compression=None) as out, pa.ipc.new_file(out, block.schema) as file:
            file.write_table(block)
        return pa.table({"file": [f"{folder}/{name}"]})

    return sorted(r["file"] for r in found.withColumn("part", part).groupBy("part").applyInArrow(put, "file string").collect())


def load(file: str) -> list[Table]:
    """The tables of a block, one per pattern length; a worker holds those of one block at a time."""
    if file not in _held:
        _held.clear()
        store, path = fs.FileSystem.from_uri(file)
        with store.open_input_file(path) as source:
            block = pa.ipc.open_file(source).read_all()
        _held[file] = compiled(block)
    return _held[file]


_held: dict[str, list[Table]] = {}


def compiled(block: pa.Table) -> list[Table]:
    tables = []
    for length in sorted(set(block.column("length").to_pylist())):
        same = block.filter(pc.equal(block.column("length"), length))
        patterns, items = (same.column(c).combine_chunks() for c in ("pattern", "items"))
        hashes = np.concatenate([words.hashes for words in word_runs(patterns, ALNUM)]).reshape(-1, length)
        tables.append(Table(length, patterns, hashes, items))
    return tables


def contamination(benchmark: DataFrame, text: Column, *, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> Column:
    """A struct of n_words, n_hit and the sorted ids of items with occurring windows, for `text`."""
    files = pattern_blocks(benchmark, window, block_bytes)

    @F.arrow_udf(RESULT)
    def mark(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        order = list(files)
        for texts in batches:
            n_words, n_hit, items = [], [], []
            runs = word_runs(texts, ALNUM)
            while held := [Hits(words) for words in islice(runs, HELD_RUNS if len(order) > 1 else 1)]:
                for file in order:
                    for hits in held:
                        hits.add(load(file))
                order.reverse()  # the block that is loaded comes first in the next round
                for hits in held:
                    hit, found = hits.result()
                    n_words.append(hits.words.counts)
                    n_hit.append(hit)
                    items += found
            count = lambda parts: pa.array(np.concatenate(parts) if parts else [], pa.int64())
            yield pa.StructArray.from_arrays(
                [count(n_words), count(n_hit), pa.array(items, pa.list_(pa.string()))], ["n_words", "n_hit", "items"]
            )

    return mark(text)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's row per document."""
    marked = docs.select("doc_id", contamination(benchmark, F.col("text")).alias("m"))
    return marked.select(
        "doc_id", "m.n_words", "m.n_hit", F.size("m.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "m.items").cast("binary"), 256).alias("items_sha256"),
        (F.col("m.n_hit") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` without any hit, columns unchanged."""
    return docs.filter(contamination(benchmark, F.col("text")).getField("n_hit") == 0)


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
