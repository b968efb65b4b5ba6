"""Byte-level BPE encoding and decoding with a sentencepiece model made from a rank file.

The model is serialised directly: every token's bytes are mapped to printable characters, one per
byte, and are a piece whose score is the negative rank, so the merge of least rank comes first,
the leftmost of equals before others. Normalisation is the identity, without a leading space,
escapes or trimming. A piece's id is its rank; the unknown piece, which a model must have, comes
last and never occurs.

Texts are split by the pattern that the ranks were made with. Each match is encoded by itself; a
match that is itself a token is that token, whatever the merges would give. Decoding maps ids to
pieces and their characters back to bytes.

Chunks (see `chunks`): a match that holds a visible character never goes on into white space, and
the pattern never looks back, so a text may be cut between the two.

Defined cases: null and empty texts have no ids, and no ids are no bytes; repeated rows and ids are
encoded alike; other columns are left alone; an empty table gives no rows; ids that no token has
raise an error in `decode`. Texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retain.llm.chunks import SPACES, ChunkEncoder, Chunks, Strings, ship_file, shipped
from retain.llm.words import runs, text_bytes

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
RUN_IDS = 1 << 19  # decoded at a time


def byte_characters() -> list[str]:
    """One printable character for each byte: itself where it is visible, else one from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(0x100 + hidden.index(b)) for b in range(256)]


CHARACTERS = byte_characters()
_SPELL = dict(enumerate(CHARACTERS))
_UNSPELL = {ord(c): b for b, c in enumerate(CHARACTERS)}


def spelled(token: bytes) -> str:
    return token.decode("latin-1").translate(_SPELL)


def spelled_matches(pattern: regex.Pattern, chunk: str) -> list[str]:
    """The matches of a chunk, spelled. Letters with or without a blank before them are one match."""
    if not (chunk.isascii() and chunk.isprintable()):
        return [spelled(m.encode()) for m in pattern.findall(chunk)]
    matches = [chunk] if (chunk[1:] if chunk[0] == " " else chunk).isalpha() else pattern.findall(chunk)
    return [m.replace(" ", CHARACTERS[0x20]) for m in matches]  # the only printable one that changes


def unspelled(piece: str) -> bytes:
    return piece.translate(_UNSPELL).encode("latin-1")


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by rank."""
    with open(path, "rb") as lines:
        ranked = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, lines))
    if [rank for rank, _ in ranked] != list(range(len(ranked))):
        raise ValueError(f"the ranks of {path} are not 0, 1, 2 and so on")
    return [token for _, token in ranked]


# The model file ---------------------------------------------------------------------------


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def _float(field: int, value: float) -> bytes:
    return _varint(field << 3 | 5) + struct.pack("<f", value)


def serialised(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose ids are the tokens' ranks."""
    # Field numbers and codes of the published model format.
    piece, score, kind, unknown = 1, 2, 3, 2
    pieces, trainer, normalizer, denormalizer = 1, 2, 3, 5
    model_type, bpe, name, dummy_prefix, trim, escape = 3, 2, 1, 3, 4, 5
    rules = _block(name, b"identity") + _number(dummy_prefix, 0) + _number(trim, 0) + _number(escape, 0)
    parts = [_block(pieces, _block(piece, spelled(t).encode()) + _float(score, float(-rank))) for rank, t in enumerate(tokens)]
    parts.append(_block(pieces, _block(piece, b"<unk>") + _number(kind, unknown)))
    return b"".join([*parts, _block(trainer, _number(model_type, bpe)), _block(normalizer, rules), _block(denormalizer, rules)])


class Encoder:
    """Ids of texts in one vocabulary; `tokens` by id."""

    def __init__(self, tokens: list[bytes], pattern: str = PATTERN):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialised(tokens))
        self.pattern = regex.compile(pattern)
        self.whole = {spelled(t): i for i, t in enumerate(tokens)}
        self.chunks = ChunkEncoder(self.encode_chunks)

    def encode_chunks(self, chunks: list[bytes]) -> list[list[int]]:
        matches = [spelled_matches(self.pattern, chunk.decode()) for chunk in chunks]
        merged = list(dict.fromkeys(m for row in matches for m in row if m not in self.whole))
        ids = dict(zip(merged, self.model.encode(merged, out_type=int, num_threads=1)))
        return [[i for m in row for i in ([self.whole[m]] if m in self.whole else ids[m])] for row in matches]

    def encode(self, texts: pa.Array) -> pa.Array:
        """A list of ids for each text."""
        data, offsets = text_bytes(texts)
        found = [pa.array([], pa.list_(pa.int32()))]
        for a, b in runs(offsets):
            ids, at = self.chunks.encode(Chunks(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], SPACES))
            found.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32())))
        return pa.concat_arrays(found)


class Decoder:
    """Bytes of ids, from the model's pieces by the inverse of the mapping."""

    def __init__(self, tokens: list[bytes]):
        self.pieces = Strings([unspelled(spelled(t)) for t in tokens])

    def decode(self, lists: pa.Array) -> pa.Array:
        """The bytes of each list of ids."""
        ids = lists.flatten().to_numpy()
        offsets = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())])
        found = [pa.array([], pa.binary())]
        for a, b in runs(offsets, RUN_IDS):
            some, at = ids[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            ends = np.concatenate([[0], np.cumsum(self.pieces.size[some])])[at]
            buffers = [None, pa.py_buffer(ends.astype(np.int32)), self.pieces.joined(some)]
            found.append(pa.Array.from_buffers(pa.binary(), b - a, buffers))
        return pa.concat_arrays(found)


# Columns ------------------------------------------------------------------------------------

_loaded: dict[tuple[type, str], Encoder | Decoder] = {}


def loaded(kind: type, name: str) -> Encoder | Decoder:
    """The coder of a shipped rank file; a worker makes it once."""
    if (kind, name) not in _loaded:
        _loaded[kind, name] = kind(read_ranks(shipped(name)))
    return _loaded[kind, name]


def encode(spark: SparkSession, text: Column, vocabulary: str = VOCABULARY) -> Column:
    """An array of token ids."""
    name = ship_file(spark, vocabulary)

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield loaded(Encoder, name).encode(texts)

    return ids(text)


def decode(spark: SparkSession, ids: Column, vocabulary: str = VOCABULARY) -> Column:
    """The bytes that an array of token ids stands for."""
    name = ship_file(spark, vocabulary)

    @F.arrow_udf("binary")
    def whole(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            yield loaded(Decoder, name).decode(lists)

    return whole(ids)


CODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])


def round_trip(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, the ids of the text and the bytes they decode to, in one worker and in runs of about 2 MB of text."""
    name = ship_file(docs.sparkSession, vocabulary)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = loaded(Encoder, name), loaded(Decoder, name)
        for batch in batches:
            doc_ids, texts = batch.columns
            size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy())
            for a, b in runs(np.concatenate([[0], size])):
                ids = encoder.encode(texts.slice(a, b - a))
                yield pa.RecordBatch.from_arrays([doc_ids.slice(a, b - a), ids, decoder.decode(ids)], schema=CODED)

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return columns.mapInArrow(coded, "doc_id long, ids array<int>, decoded binary")


def report(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """The contract's row per document: digests of the ids and of the bytes they decode to."""
    return round_trip(docs, vocabulary).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
