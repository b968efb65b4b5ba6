"""Tokenizer alignment against a plain version that encodes whole texts and compares all tokens."""

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import tokenizers
from cases import EDGE, rows

from retain.llm import alignment
from retain.llm.byte_bpe import unspelled
from retain.llm.chunks import BLANK, SPACES, Chunks, cuts
from retain.llm.words import text_bytes

ODD = [
    "a▁b", "▁", " lead", "trail ", "  ", "\n", "tab\tnew\n\nline  two   three ", "<|endoftext|> <s></s> <0x41>", "it's I'LL don't",
    "ﬁ É é", "x   y\u0085z", "\x00 nul", "مرحبا بالعالم Привет мир", "語 中文　wide \xa0 nb", "👩‍👩‍👧 ok", "a" * 3000, "  ​",
]


@pytest.fixture(scope="module")
def whole():
    first = tokenizers.Tokenizer.from_file(alignment.FIRST)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=alignment.SECOND)

    def encode(text):
        a = first.encode(" " + text, add_special_tokens=False).ids
        b = second.encode(text)
        byte = lambda p: bytes([int(p[3:-1], 16)]) if p.startswith("<0x") else p.replace("▁", " ").encode()
        return (a, [unspelled(first.id_to_token(i)) for i in a]), (b, [byte(second.id_to_piece(i)) for i in b])

    return encode


def plain(docs, encode):
    """The contract, token by token."""
    found, holders = [], Counter()
    for doc_id, text in docs:
        a, b, links, groups = [], [], [], ""
        if text:
            (a, bytes_a), (b, bytes_b) = encode(text)
            if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                a, b = [], []
        if a:
            end_a, end_b = (np.cumsum([len(t) for t in side]) for side in (bytes_a, bytes_b))
            begin_a, begin_b = end_a - [len(t) for t in bytes_a], end_b - [len(t) for t in bytes_b]
            for i in range(len(a)):
                for j in range(np.searchsorted(end_b, begin_a[i], "right"), np.searchsorted(begin_b, end_a[i], "left")):
                    links.append((a[i], b[j]))
            cut, i, j = sorted(set(end_a) & set(end_b)), 0, 0
            parts = []
            for c in cut:
                k, m = np.searchsorted(end_a, c) + 1, np.searchsorted(end_b, c) + 1
                parts.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
                i, j = k, m
            groups = ";".join(parts)
        found.append((doc_id, a, b, links, groups))
        holders.update(set(links))
    most = defaultdict(int)
    for (x, _), n in holders.items():
        most[x] = max(most[x], n)
    return sorted(
        [
            (d, len(a), len(b), groups.count("|"), len(links), sum(holders[p] == most[p[0]] for p in links),
             sum(holders[p] for p in links), groups)
            for d, a, b, links, groups in found
        ],
        key=repr,
    )


COLUMNS = "doc_id n_a n_b n_groups n_links n_best count_sum groups".split()


@pytest.mark.parametrize("block_bytes", [1, 4000, 8 << 20])
def test_equals_the_plain_version(spark, stored, frame, whole, block_bytes):
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(60).collect()
    docs = [(100 + i, t) for i, t in enumerate(ODD)] + [(200 + i, r.text) for i, r in enumerate(texts)] + EDGE
    _, df = stored(frame(docs))
    assert rows(alignment.align(df, block_bytes=block_bytes), *COLUMNS) == plain(docs, whole)


def test_digest_and_empty_tables(spark, stored, frame):
    _, df = stored(frame([(1, "some text"), (2, None), (3, "a▁b")]))
    found = {r.doc_id: r for r in alignment.report(df).collect()}
    assert len(found[1].groups_sha256) == 64
    assert found[2][1:] == found[3][1:] == (0, 0, 0, 0, 0, 0, "")
    _, none = stored(frame([(1, "x")]).filter("false"), "none")
    assert alignment.align(none).collect() == []
    _, silent = stored(frame([(1, None), (2, "")]), "silent")
    assert rows(alignment.align(silent), *COLUMNS) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_chunks_hide_no_cut_that_the_whole_text_lacks(whole):
    """Every code point beside blanks and letters, in both vocabularies."""
    first, second = alignment.ByteTokenizer(alignment.FIRST), alignment.PieceTokenizer(alignment.SECOND)
    points = [*range(0x3100), *range(0xF900, 0x10000, 7), *range(0x10000, 0x20000, 97)]
    texts = [f"a{c}{c} b1{c} {c}\n{c}x " for c in map(chr, points)]
    data, offsets = alignment.with_blanks(pa.array(texts))
    chunks = Chunks(data, offsets, BLANK)
    for side, want in ((first, lambda t: whole(t)[0][0]), (second, lambda t: whole(t)[1][0])):
        ids, at = side.chunks.encode(chunks)
        assert [ids[i:j].tolist() for i, j in zip(at, at[1:])] == [want(t) for t in texts]


def test_cuts_lie_before_space_and_behind_what_is_seen():
    text = "a b  c\td  e　 fé g語 h😀 i  j \nk"
    data, _ = text_bytes(pa.array([text]))
    behind = {text.encode()[:at].decode()[-1] for at in cuts(data, SPACES).tolist()}
    assert behind == set("abcéd語😀ej") - {"d", "e"}


def test_pieces_with_an_inner_blank_are_refused(monkeypatch):
    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "id_to_piece", lambda self, i: "a▁b")
    with pytest.raises(ValueError):
        alignment.PieceTokenizer(alignment.SECOND)
