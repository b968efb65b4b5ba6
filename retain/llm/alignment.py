"""Alignment of two tokenizers' ids on the bytes they stand for.

Tasks work on runs of texts as Arrow tables. A tokenizer's ids of a run are one list array:
flattened, with parent indices for the documents. The cumulative sum of the tokens' byte lengths,
less its value where the document starts, is where each token ends. An Acero full outer hash join
of the two tables on (document, end) gives the places where both end, which cut the text into
groups, and, in order of place, all links: between two neighbouring ends of either side lies the
overlap of exactly one token of each. `Table.group_by` reduces links to the distinct id pairs of a
document, and those of a block of documents to partial counts. Spark adds the partial counts of all
blocks, finds the highest of each first id, and returns to each block the counts of its own pairs;
documents hold places in their block's list of pairs, so only lists of numbers go through a shuffle.

A block has about `block_bytes` of texts, one document at least, so what a task holds is bounded by
that and by the longest document. A pair occurs once per block in what is shuffled, however common.

Texts are tokenized chunk by chunk (see `chunks`), cut before a blank behind a visible character:
the splitting pattern of the first vocabulary cuts there, and no piece of the second holds a blank
behind another character, so no merge crosses it; `PieceTokenizer` refuses a model that has one.

Defined cases: null and empty texts, and texts whose joined token bytes differ from a blank and the
text, have no tokens, so zeros and an empty groups text; null and repeated ids are kept, each row
counts as a document of its own; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import sentencepiece
import tokenizers
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retain.llm.byte_bpe import spelled_matches, unspelled
from retain.llm.chunks import BLANK, ChunkEncoder, Chunks, Strings, repeated, ship_file, shipped
from retain.llm.common import materialize
from retain.llm.words import text_bytes, runs

FIRST = public_tokenizers.path("byte_bpe_50k.json")
SECOND = public_tokenizers.path("piece_bpe_32k.model")
RUN_BYTES = 1 << 20
BLOCK_BYTES = 8 << 20
UNDERLINE = "▁"  # stands for a blank in pieces

PART = pa.schema([
    ("block", pa.string()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups", pa.string()), ("pairs", pa.list_(pa.int32())), ("times", pa.list_(pa.int32())),
    ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("n_docs", pa.list_(pa.int64())),
])
PART_DDL = (
    "block string, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<int>, "
    "times array<int>, a array<int>, b array<int>, n_docs array<long>"
)
RESULT = pa.schema([*(PART.field(i) for i in range(1, 6)), ("n_best", pa.int64()), ("count_sum", pa.int64()), PART.field(6)])
RESULT_DDL = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
)


class ByteTokenizer:
    """A byte-level BPE of the `tokenizers` library, with the bytes of each token."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.model = tokenizers.Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        size = self.model.get_vocab_size()
        special = self.model.get_added_tokens_decoder()
        spelled = (self.model.id_to_token(i) for i in range(size))
        self.pieces = Strings([t.encode() if i in special else unspelled(t) for i, t in enumerate(spelled)])
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.chunks = ChunkEncoder(self.encode_chunks)

    def encode_chunks(self, chunks: list[bytes]) -> Iterator[list[int]]:
        """By the library's merges, match by match: its way over whole texts takes several times as long."""
        merges = self.model.model.tokenize
        for chunk in chunks:
            yield [token.id for match in spelled_matches(self.pattern, chunk.decode()) for token in merges(match)]


class PieceTokenizer:
    """A sentencepiece model that puts a blank before each text; chunks have that blank already."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        spelled = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(UNDERLINE in piece.lstrip(UNDERLINE) for piece in spelled):
            raise ValueError(f"{path} has pieces with a blank behind another character")
        byte = [self.model.is_byte(i) for i in range(len(spelled))]
        self.pieces = Strings([bytes([int(p[1:-1], 16)]) if b else p.replace(UNDERLINE, " ").encode() for p, b in zip(spelled, byte)])
        self.blank = self.model.piece_to_id(UNDERLINE)
        self.chunks = ChunkEncoder(self.encode_chunks)

    def encode_chunks(self, chunks: list[bytes]) -> list[list[int]]:
        ids = self.model.encode([c[1:].decode() for c in chunks], num_threads=1)
        return [i or [self.blank] for i in ids]  # the model puts no blank before nothing


_loaded: dict[str, ByteTokenizer | PieceTokenizer] = {}


def loaded(kind: type, name: str) -> ByteTokenizer | PieceTokenizer:
    """The tokenizer of a shipped file; a worker makes it once."""
    if name not in _loaded:
        _loaded[name] = kind(shipped(name))
    return _loaded[name]


def with_blanks(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts, each with a blank before it; nulls and empty texts stay empty."""
    texts = column.fill_null("") if column.null_count else column
    return text_bytes(pc.if_else(pc.equal(texts, ""), texts, pc.binary_join_element_wise("", texts, " ")))


def faithful(ids: np.ndarray, at: np.ndarray, pieces: Strings, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts the ids spell byte by byte."""
    ends = np.concatenate([[0], np.cumsum(pieces.size[ids])])[at]
    same = np.diff(ends) == np.diff(offsets)
    spelled = np.frombuffer(pieces.joined(ids), np.uint8)
    if same.all():
        wrong = np.concatenate([[0], np.cumsum(spelled != data)])
        return wrong[offsets[1:]] == wrong[offsets[:-1]]
    for i in np.flatnonzero(same):
        same[i] = np.array_equal(spelled[ends[i] : ends[i + 1]], data[offsets[i] : offsets[i + 1]])
    return same


class Run:
    """The aligned tokens of a run of texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first, second):
        chunks = Chunks(data, offsets, BLANK)
        sides = [(side, *side.chunks.encode(chunks)) for side in (first, second)]
        sound = np.logical_and.reduce([faithful(ids, at, side.pieces, data, offsets) for side, ids, at in sides])
        self.a, self.b = (self.tokens(side, ids, at, sound) for side, ids, at in sides)
        self.n = len(offsets) - 1
        ends = self.a.join(self.b, ["doc", "end"], join_type="full outer", use_threads=False)
        # Ends are unique within a run when counted from its start, so one key orders them.
        start = np.concatenate([[0], np.cumsum(np.where(sound, np.diff(offsets), 0))])
        place = start[ends["doc"].to_numpy()] + ends["end"].to_numpy()
        ends = ends.take(pa.array(np.argsort(place, kind="stable")))
        self.cut = pc.and_(pc.is_valid(ends["at_a"]), pc.is_valid(ends["at_b"])).to_numpy()
        # The token that goes on to the next end of its side is the one that ends there.
        self.links = pa.table({
            "doc": ends["doc"], "a": pc.fill_null_backward(ends["a"]), "b": pc.fill_null_backward(ends["b"]),
        })
        self.cut_a, self.cut_b = (ends[c].to_numpy(zero_copy_only=False)[self.cut].astype(np.int64) for c in ("at_a", "at_b"))

    @staticmethod
    def tokens(side, ids: np.ndarray, at: np.ndarray, sound: np.ndarray) -> pa.Table:
        kept = np.where(sound, np.diff(at), 0)
        lists = pa.LargeListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(kept)])), pa.array(ids if sound.all() else ids[repeated(at[:-1], kept)])
        )
        flat, doc = pc.list_flatten(lists), pc.list_parent_indices(lists)
        reach = pc.cumulative_sum(pa.array(side.pieces.size[flat.to_numpy()])).to_numpy()
        before = np.concatenate([[0], reach])[lists.offsets.to_numpy()[:-1]]
        name = "a" if isinstance(side, ByteTokenizer) else "b"
        return pa.table({
            "doc": doc.cast(pa.int32()), "end": (reach - before[doc.to_numpy()]).astype(np.int32), name: flat,
            f"at_{name}": np.arange(len(flat), dtype=np.int32),
        })

    def counts(self, doc: pa.ChunkedArray | pa.Array) -> np.ndarray:
        return np.bincount(np.asarray(doc), minlength=self.n)

    def pairs(self) -> pa.Table:
        """doc, a, b, times: the distinct id pairs of each document."""
        found = self.links.group_by(["doc", "a", "b"], use_threads=False).aggregate([([], "count_all")])
        return found.rename_columns(["doc", "a", "b", "times"]).sort_by("doc")

    def groups(self, decimal: Strings) -> pa.Array:
        """Per document the ids of its groups: `a1,a2|b1;a3|b2`."""
        n_a, n_b = len(self.a), len(self.b)
        if not n_a:
            return pa.array([""] * self.n, pa.string())
        group_a = np.searchsorted(self.cut_a, np.arange(n_a))
        group_b = np.searchsorted(self.cut_b, np.arange(n_b))
        # A group's ids of one side follow those of the other.
        before_b = np.concatenate([[0], self.cut_b + 1])[group_a]
        place_a, place_b = np.arange(n_a) + before_b, np.arange(n_b) + self.cut_a[group_b] + 1
        ids, sign = np.empty(n_a + n_b, np.int64), np.full(n_a + n_b, ord(","), np.uint8)
        ids[place_a], ids[place_b] = self.a["a"].to_numpy(), self.b["b"].to_numpy()
        sign[place_a[self.cut_a]], sign[place_b[self.cut_b]] = ord("|"), ord(";")
        size = decimal.size[ids]  # with room for the sign
        ends = np.cumsum(size)
        data = np.frombuffer(decimal.joined(ids), np.uint8).copy()
        data[ends - 1] = sign
        # The sign behind a document's last id goes.
        tokens = self.counts(self.a["doc"]) + self.counts(self.b["doc"])
        reach = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(tokens)])]
        last = reach[1:][np.diff(reach) > 0] - 1
        kept = np.ones(len(data), bool)
        kept[last] = False
        bounds = reach - np.concatenate([[0], np.cumsum(np.diff(reach) > 0)])
        buffers = [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data[kept])]
        return pa.Array.from_buffers(pa.large_string(), self.n, buffers).cast(pa.string())


class Block:
    """Documents and the partial counts of their pairs, until they are written."""

    def __init__(self, name: str):
        self.name, self.bytes = name, 0
        self.docs: list[dict[str, pa.Array]] = []
        self.found: list[pa.Table] = []

    def add(self, doc_ids: pa.Array, run: Run, decimal: Strings, n_bytes: int) -> None:
        pairs = run.pairs()
        numbers = {
            "n_a": run.counts(run.a["doc"]), "n_b": run.counts(run.b["doc"]), "n_links": run.counts(run.links["doc"]),
            "n_groups": run.counts(run.links["doc"].filter(pa.array(run.cut))), "n_pairs": run.counts(pairs["doc"]),
        }
        self.docs.append({"doc_id": doc_ids, "groups": run.groups(decimal)} | {k: pa.array(v) for k, v in numbers.items()})
        self.found.append(pairs.select(["a", "b", "times"]))
        self.bytes += n_bytes

    def rows(self) -> Iterator[pa.RecordBatch]:
        found = pa.concat_tables(self.found).combine_chunks()
        partial = found.group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")])
        key = lambda t: pa.array(t["a"].to_numpy().astype(np.int64) << 32 | t["b"].to_numpy())
        place, times = pc.index_in(key(found), key(partial)), found["times"].combine_chunks().cast(pa.int32())
        at = 0
        for docs in self.docs:
            ends = at + np.concatenate([[0], np.cumsum(docs.pop("n_pairs").to_numpy())])
            at = int(ends[-1])
            lists = {
                name: pa.ListArray.from_arrays(pa.array(ends - ends[0], pa.int32()), values.slice(ends[0], at - ends[0]))
                for name, values in (("pairs", place), ("times", times))
            }
            yield filled(docs | lists, len(docs["doc_id"]), self.name)
        one = lambda c, t: pa.array([c.combine_chunks().cast(t)], pa.list_(t))
        yield filled({
            "a": one(partial["a"], pa.int32()), "b": one(partial["b"], pa.int32()), "n_docs": one(partial["count_all"], pa.int64()),
        }, 1, self.name)


def filled(columns: dict[str, pa.Array], n: int, block: str) -> pa.RecordBatch:
    columns = columns | {"block": pa.repeat(block, n)}
    return pa.RecordBatch.from_arrays(
        [columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in PART], schema=PART
    )


def aligned(docs: DataFrame, first: str, second: str, block_bytes: int, run_bytes: int = RUN_BYTES) -> DataFrame:
    """Rows of documents (with `pairs`) and of blocks (with `a`, `b`, `n_docs`)."""
    spark = docs.sparkSession
    names = [ship_file(spark, path) for path in (first, second)]

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = tuple(loaded(kind, name) for kind, name in zip((ByteTokenizer, PieceTokenizer), names))
        # Each number with one more character, where a sign goes.
        decimal = Strings([b"%d," % i for i in range(max(len(s.pieces.size) for s in sides))])
        task, n_blocks = TaskContext.get().partitionId(), 0
        block = Block(f"{task}-0")
        for batch in batches:
            data, offsets = with_blanks(batch.column(1))
            for i, j in runs(offsets, run_bytes):
                run = Run(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], *sides)
                block.add(batch.column(0).slice(i, j - i), run, decimal, int(offsets[j] - offsets[i]))
                if block.bytes >= block_bytes:
                    yield from block.rows()
                    n_blocks += 1
                    block = Block(f"{task}-{n_blocks}")
        if block.docs:
            yield from block.rows()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(parts, PART_DDL)


def with_counts(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """A block's documents with what the counts of its pairs add up to."""
    count, best = np.zeros(0, np.int64), np.zeros(0, bool)
    if len(counts):
        lists = counts["counts"].combine_chunks().flatten()
        count, best = lists.field("n").to_numpy(), lists.field("best").to_numpy(zero_copy_only=False)
    pairs = docs["pairs"].combine_chunks()
    place, times = pairs.flatten().to_numpy(), docs["times"].combine_chunks().flatten().to_numpy()
    ends = np.concatenate([[0], np.cumsum(pairs.value_lengths().to_numpy())])
    total = lambda v: np.diff(np.concatenate([[0], np.cumsum(v)])[ends])
    sums = {"n_best": pa.array(total(times * best[place]), pa.int64()), "count_sum": pa.array(total(times * count[place]), pa.int64())}
    return pa.table({f.name: sums[f.name] if f.name in sums else docs[f.name] for f in RESULT}, schema=RESULT)


def align(
    docs: DataFrame, *, first: str = FIRST, second: str = SECOND, groups: Callable[[Column], Column] = lambda text: text,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document with its alignment.

    `groups` says what is kept of the groups' text (all by default, a digest for instance);
    it is applied before anything is written.
    """
    parts = aligned(docs, first, second, block_bytes).withColumn("groups", groups(F.col("groups")))
    parts = materialize(parts, "alignment")
    partial = parts.filter("a is not null").select("block", F.posexplode(F.arrays_zip("a", "b", "n_docs")).alias("place", "p"))
    partial = partial.select("block", "place", "p.a", "p.b", "p.n_docs")
    counts = partial.groupBy("a", "b").agg(F.sum("n_docs").alias("n"))
    highest = counts.groupBy("a").agg(F.max("n").alias("most"))
    counts = counts.join(highest, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))
    back = partial.join(counts, ["a", "b"]).groupBy(F.col("block").alias("of_block")).agg(
        F.sort_array(F.collect_list(F.struct("place", "n", "best"))).alias("counts")  # at most the pairs of one block
    )
    rows = parts.filter("a is null").select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times")
    return rows.groupBy("block").cogroup(back.groupBy("of_block")).applyInArrow(with_counts, RESULT_DDL)


def report(docs: DataFrame) -> DataFrame:
    """The contract's row per document: the groups as a digest."""
    digest = lambda text: F.when(text == "", "").otherwise(F.sha2(text, 256))
    return align(docs, groups=digest).withColumnRenamed("groups", "groups_sha256")
