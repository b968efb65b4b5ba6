"""Byte-level BPE against the library whose ranks it takes, and back again."""

import hashlib

import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from cases import EDGE, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from retain.llm import byte_bpe, chunks

TOKENS = byte_bpe.read_ranks(byte_bpe.VOCABULARY)
ODD = [
    "  \t\n ", " " * 5000 + "x", "\n" * 3000, "’" * 999, "don't I'LL we'll", "語" * 5000, "<|endoftext|>", "\x00\x1c\x1d a\x1f b",
    "x\u0085y  z　 w", "é ́", "👩‍👩‍👧 ok", "١٢٣ ½ Ⅷ 12ab", "ĠĊ Ā",
]


@pytest.fixture(scope="module")
def reference():
    ranks = {t: i for i, t in enumerate(TOKENS)}
    return tiktoken.Encoding("reference", pat_str=byte_bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.Encoder(TOKENS)


@pytest.fixture(scope="module")
def decoder():
    return byte_bpe.Decoder(TOKENS)


def test_every_byte_has_a_character_of_its_own():
    assert len(set(byte_bpe.CHARACTERS)) == 256
    every = bytes(range(256))
    assert byte_bpe.unspelled(byte_bpe.spelled(every)) == every
    assert all(c.isprintable() and not c.isspace() for c in byte_bpe.CHARACTERS)


def test_the_model_is_the_vocabulary():
    model = sentencepiece.SentencePieceProcessor(model_proto=byte_bpe.serialised(TOKENS))
    assert model.get_piece_size() == len(TOKENS) + 1 and model.unk_id() == len(TOKENS)
    for i in (0, 1, 255, 256, 5000, len(TOKENS) - 1):
        assert byte_bpe.unspelled(model.id_to_piece(i)) == TOKENS[i]
        assert model.get_score(i) == -i


def test_equals_the_library_on_documents_and_odd_texts(spark, encoder, decoder, reference):
    texts = ODD + [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    ids = encoder.encode(pa.array(texts))
    assert ids.to_pylist() == [reference.encode_ordinary(t) for t in texts]
    assert decoder.decode(ids).to_pylist() == [t.encode() for t in texts]


def test_equals_the_library_on_every_kind_of_character(encoder, reference):
    texts = [f"a{c}{c} b1{c} {c}\n{c}x " for c in map(chr, [*range(0x3100), *range(0xE000, 0x30000, 37)])]
    assert encoder.encode(pa.array(texts)).to_pylist() == reference.encode_ordinary_batch(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), max_size=6))
def test_equals_the_library_on_any_text(texts):
    encoder, decoder, ranks = test_equals_the_library_on_any_text.made
    ids = encoder.encode(pa.array(texts, pa.string()))
    assert ids.to_pylist() == [ranks.encode_ordinary(t) for t in texts]
    assert decoder.decode(ids).to_pylist() == [t.encode() for t in texts]


test_equals_the_library_on_any_text.made = (
    byte_bpe.Encoder(TOKENS),
    byte_bpe.Decoder(TOKENS),
    tiktoken.Encoding("any", pat_str=byte_bpe.PATTERN, mergeable_ranks={t: i for i, t in enumerate(TOKENS)}, special_tokens={}),
)


def test_a_match_that_is_a_token_needs_no_merges():
    tokens = [bytes([b]) for b in range(256)] + [b"abc"]  # no merge leads to it
    encoder = byte_bpe.Encoder(tokens)
    reference = tiktoken.Encoding("small", pat_str=byte_bpe.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    texts = ["abc", "abc abcd", "xabc"]
    assert encoder.encode(pa.array(texts)).to_pylist() == [reference.encode_ordinary(t) for t in texts]


def test_what_is_kept_is_bounded(monkeypatch, encoder, reference):
    monkeypatch.setattr(chunks, "KEPT_CHUNKS", 10)
    for text in ("one two three four five six seven", "eight nine ten eleven twelve one two", "one two three"):
        assert encoder.encode(pa.array([text])).to_pylist() == [reference.encode_ordinary(text)]
    assert len(encoder.chunks.known) <= 20


def test_columns_and_report(spark, frame, reference):
    docs = EDGE + [(50 + i, t) for i, t in enumerate(ODD)]
    df = frame(docs)
    ids = df.select("doc_id", byte_bpe.encode(spark, F.col("text")).alias("ids"))
    assert rows(ids, "doc_id", "ids") == sorted([(d, reference.encode_ordinary(t or "")) for d, t in docs], key=repr)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = [
        (d, len(i := reference.encode_ordinary(t or "")), sha(",".join(map(str, i)).encode()), sha((t or "").encode())) for d, t in docs
    ]
    assert rows(byte_bpe.report(df), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    assert byte_bpe.report(frame([(1, "x")]).filter("false")).collect() == []


def test_null_ids_are_no_bytes(spark):
    lists = spark.createDataFrame([(1, None), (2, []), (3, [0, 1])], "i int, ids array<int>")
    found = lists.select("i", byte_bpe.decode(spark, F.col("ids")).alias("b"))
    assert {r.i: bytes(r.b) for r in found.collect()} == {1: b"", 2: b"", 3: TOKENS[0] + TOKENS[1]}
