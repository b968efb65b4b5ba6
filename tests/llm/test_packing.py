import numpy as np
from cases import EDGE
from pyspark.sql import functions as F

from retain.llm import packing
from retain.llm.common import read


def restored(rows):
    parts = {}
    for r in rows:
        for doc, start, ids in packing.unpacked(r.asDict()):
            parts.setdefault(doc, []).append((start, ids))
    return parts


def test_round_trip(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    rows = packing.pack(docs, length=256, pool_tokens=20_000).collect()
    plain = packing.load(packing.VOCABULARY)
    parts = restored(rows)
    for doc in docs.collect():
        ids = np.concatenate([x for _, x in sorted(parts[doc["doc_id"]], key=lambda p: p[0])])
        assert ids.tolist() == plain.encode_ordinary(doc["text"])
    full = sum(r["n_tokens"] for r in rows) / (256 * len(rows))
    assert full > 0.95 and all(len(r["input_ids"]) == 512 and r["n_tokens"] <= 256 for r in rows)


def test_odd_white_space_is_cut_safely():
    plain, encoder = packing.load(packing.VOCABULARY), packing.Encoder(packing.VOCABULARY)
    import pyarrow as pa

    from retain.llm.words import text_bytes

    for text in ["a  b\n\n c", " x", "x ", "é  y \tz", "it's  they'll\r\n", "\t\t", "a\u0085 b", "語 中 1 2", "Ã  à \x1c y"]:
        ids, at = encoder.encode(*text_bytes(pa.array([text, text])))
        assert ids[: at[1]].tolist() == plain.encode_ordinary(text) == ids[at[1] :].tolist()


def test_words_whose_polynomials_agree_modulo_a_power_of_two():
    """The Thue-Morse word and its complement have equal polynomial hashes modulo 2^64 for any odd base."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    text = f"x {word} y {word.translate(str.maketrans('ab', 'ba'))} z"
    data, offsets = np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)])
    encoder = packing.Encoder(packing.VOCABULARY)
    assert encoder.encode(data, offsets)[0].tolist() == encoder.encoding.encode_ordinary(text)


def test_best_fit_decreasing():
    packed = packing.best_fit([6, 3, 8, 2, 5, 5, 1], 10)
    assert packed == [[2, 3], [0, 1, 6], [4, 5]]


def brute_best_fit(lengths, length):
    packed, room = [], []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [r for r in room if r >= lengths[i]]
        if fits:
            k = max(j for j, r in enumerate(room) if r == min(fits))
        else:
            k = len(packed)
            packed.append([])
            room.append(length)
        packed[k].append(i)
        room[k] -= lengths[i]
    return sorted(map(sorted, packed))


def test_segment_tree_equals_search():
    import random

    draw = random.Random(4)
    for _ in range(50):
        lengths = [draw.randint(1, 64) for _ in range(draw.randint(0, 80))]
        found = packing.best_fit(lengths, 64)
        room = lambda packed: sorted(sum(lengths[i] for i in p) for p in packed)
        assert room(found) == room(brute_best_fit(lengths, 64))


def test_edge_cases(spark, frame):
    rows = packing.pack(frame(EDGE), length=64).collect()
    parts = restored(rows)
    assert set(parts) == {1, 4, 5, None, 6, 7, 8, 9}
    for r in rows:
        positions = packing.position_ids(r.asDict(), 64)
        assert all(positions[k] == 0 for k in r["position_resets"]) and r["cu_seqlens"][-1] == r["n_tokens"]
    assert packing.pack(frame([])).agg(F.count("*")).first()[0] == 0
