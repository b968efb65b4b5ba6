"""Token ids packed into fixed-length sequences by best-fit decreasing.

Tokenizing: a text is cut where white space follows a visible character, which no token of a
byte-level vocabulary with the usual splitting pattern spans. Equal chunks, compared by their bytes,
are encoded once and their ids kept, so the cost follows the number of distinct words.

Packing: documents longer than a sequence are cut into full sequences and a rest, without loss.
The pieces of one pool (a run of a task's documents, bounded by a token budget) are placed
longest first, each in the sequence with the least remaining room that fits it; a segment tree
over room values finds that in logarithmic time. A pool never waits for another, so nothing is
shuffled; its last, partly filled sequences cost a fraction of a per cent.

A row is one sequence: its id matrix row (little-endian, padded), cumulative segment lengths, and
where positions restart. Defined cases: null and empty texts have no tokens and appear in no
sequence; null ids are kept as null; repeated rows are separate documents; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retain.llm.chunks import SPACES, ChunkEncoder, Chunks, ship_file, shipped
from retain.llm.words import runs, text_bytes

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the splitting pattern that the vocabulary was made with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LENGTH = 2048
POOL_TOKENS = 4 << 20

ROW = (
    "pool string, sequence int, input_ids binary, n_tokens int, cu_seqlens array<int>, position_resets array<int>, "
    "doc_ids array<long>, starts array<long>"
)


def load(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Ids of whole texts; distinct chunks are encoded once (see `chunks`)."""

    def __init__(self, path: str):
        self.encoding = load(path)
        self.chunks = ChunkEncoder(lambda chunks: (self.encoding.encode_ordinary(c.decode()) for c in chunks))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the n + 1 offsets of the texts in them."""
        return self.chunks.encode(Chunks(data, offsets, SPACES))


class Room:
    """The open sequences by remaining room, in a segment tree over room values."""

    def __init__(self, length: int):
        self.size = 1 << length.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(length + 1)]

    def put(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        node = self.size + room
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The sequence with the least room of at least `need`, and that room."""
        node = self.size + need
        if not self.count[node]:
            while node > 1 and not (node % 2 == 0 and self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.size
        while node:
            self.count[node] -= 1
            node >>= 1
        return self.open[room].pop(), room


def best_fit(lengths: list[int], length: int) -> list[list[int]]:
    """Pieces (by index) of each sequence, longest piece first, ties by index."""
    room, packed = Room(length), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = room.take(lengths[i])
        if found is None:
            found = len(packed), length
            packed.append([])
        sequence, left = found
        packed[sequence].append(i)
        if left > lengths[i]:
            room.put(left - lengths[i], sequence)
    return packed


def pack_pool(pool: str, docs: list[tuple[int | None, np.ndarray]], length: int, pad: int, dtype: str) -> Iterator[dict]:
    pieces = [(doc, at, ids[at : at + length]) for doc, ids in docs for at in range(0, len(ids), length)]
    for k, members in enumerate(best_fit([len(p[2]) for p in pieces], length)):
        row = np.full(length, pad, dtype)
        ends = np.cumsum([len(pieces[i][2]) for i in members]).tolist()
        for i, end in zip(members, ends):
            row[end - len(pieces[i][2]) : end] = pieces[i][2]
        yield {
            "pool": pool, "sequence": k, "input_ids": row.tobytes(), "n_tokens": ends[-1], "cu_seqlens": [0, *ends],
            "position_resets": [0, *ends[:-1]], "doc_ids": [pieces[i][0] for i in members], "starts": [pieces[i][1] for i in members],
        }


def pack(
    docs: DataFrame, *, vocabulary: str = VOCABULARY, length: int = LENGTH, pool_tokens: int = POOL_TOKENS, pad: int = 0
) -> DataFrame:
    """The packed sequences of `docs` (doc_id, text). Ids are 16-bit if the vocabulary allows it."""
    schema = pa.schema([
        ("pool", pa.string()), ("sequence", pa.int32()), ("input_ids", pa.binary()), ("n_tokens", pa.int32()),
        ("cu_seqlens", pa.list_(pa.int32())), ("position_resets", pa.list_(pa.int32())),
        ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())),
    ])

    shipped_as = ship_file(docs.sparkSession, vocabulary)

    def pools(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, held, tokens, n_pools = Encoder(shipped(shipped_as)), [], 0, 0
        dtype = "<u2" if encoder.encoding.max_token_value < 1 << 16 else "<u4"

        def flush():
            nonlocal held, tokens, n_pools
            rows = list(pack_pool(f"{TaskContext.get().partitionId()}-{n_pools}", held, length, pad, dtype))
            held, tokens, n_pools = [], 0, n_pools + 1
            for at in range(0, len(rows), 1000):
                yield pa.RecordBatch.from_pylist(rows[at : at + 1000], schema)

        for batch in batches:
            names = batch.column(0).to_pylist()
            data, offsets = text_bytes(batch.column(1))
            for a, b in runs(offsets):
                ids, at = encoder.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                held += [(names[a + i], ids[at[i] : at[i + 1]]) for i in range(b - a)]
                tokens += len(ids)
                if tokens >= pool_tokens:
                    yield from flush()
        if held:
            yield from flush()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pools, ROW)


def unpacked(row: dict, dtype: str = "<u2") -> list[tuple[int | None, int, np.ndarray]]:
    """(doc_id, start in the document, ids) of every segment of a sequence."""
    ids, ends = np.frombuffer(row["input_ids"], dtype), row["cu_seqlens"]
    return [(d, s, ids[a:b]) for d, s, a, b in zip(row["doc_ids"], row["starts"], ends, ends[1:])]


def position_ids(row: dict, length: int) -> np.ndarray:
    """Positions that restart at 0 with every segment, and in the padding."""
    at = np.arange(length)
    begin = np.array([*row["position_resets"], row["n_tokens"]])
    return at - begin[np.searchsorted(begin, at, "right") - 1]
