import random
import re

import numpy as np
import pyarrow as pa
from cases import EDGE
from pyspark.sql import functions as F

from retain.llm import neardup
from retain.llm.common import read
from retain.llm.words import SPACED, pieces, word_runs


def shingles(text, size=3):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def brute(table, percent=85, size=3):
    sets = [shingles(t, size) for _, t in table]
    root = list(range(len(table)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(table)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(table):
        least.setdefault(top(i), []).append(d)
    return sorted(
        ((d, len(s), min((x for x in least[top(i)] if x is not None), default=None)) for i, ((d, _), s) in enumerate(zip(table, sets))),
        key=repr,
    )


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def test_driver_rows_against_brute_force(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    table = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(neardup.near_duplicates(docs, 85, 3)) == brute(table)


def test_chains_and_crowded_buckets(spark, frame, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 7)
    monkeypatch.setattr(neardup, "PIVOT_ROUNDS", 1)
    draw = random.Random(5)
    base = [f"w{draw.randint(0, 10**6)}" for _ in range(150)]
    table, now = [], list(base)
    for i in range(60):  # a chain: each links to the next, the ends are far apart
        now[draw.randrange(150)] = f"x{i}"
        table.append((1000 - i, " ".join(now)))
    for i in range(60):  # a crowd around one text, near the threshold
        other = [f"y{k}" for k in range(120)]
        for _ in range(draw.randint(0, 5)):
            other[draw.randrange(120)] = f"z{draw.randint(0, 10**6)}"
        table.append((2000 + i, " ".join(other)))
    assert got(neardup.near_duplicates(frame(table), 85, 3)) == brute(table)


def test_edge_cases(spark, frame):
    out = neardup.near_duplicates(frame(EDGE), 85, 3)
    assert got(out) == brute(EDGE)
    for r in out.collect():
        assert r["kept"] == (r["doc_id"] is not None and r["doc_id"] == r["component_id"])
    assert neardup.near_duplicates(frame([])).count() == 0


def test_keep_one(spark, frame):
    docs = frame([(3, "a b c d e f"), (1, "A b c d e f"), (2, "x y z"), (None, "q"), (4, None)])
    kept = neardup.keep_one(docs)
    assert kept.schema == docs.schema
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "4", "None"]


def test_keep_one_decides_per_row(spark, frame):
    same = "a b c d e f"
    docs = frame([(1, same), (2, "A b c d e f"), (2, "only here"), (3, "x y z"), (3, "x y z"), (None, "q"), (None, "q"), (None, same), (4, ""), (4, "")])
    kept = neardup.keep_one(docs)
    assert kept.schema == docs.schema
    want = [(1, same), (2, "only here"), (3, "x y z"), (None, "q"), (4, ""), (4, "")]
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted(want, key=repr)
    assert {(r["row"], r["cls"]) for r in kept.collect()} == {("r", 5)}
    assert neardup.keep_one(frame([])).count() == 0


def test_bands_miss_almost_nothing():
    assert (neardup.band_rows(80), neardup.band_rows(85)) == (5, 6)


def test_sketches_merge_and_estimate():
    text = lambda w: " ".join(w)
    left = [f"a{i}" for i in range(400)]
    right = left[:300] + [f"b{i}" for i in range(100)]
    (words,) = word_runs(pa.array([text(left), text(right)]), SPACED)
    elements, offsets = neardup.shingle_sets(words, 3)
    made = neardup.registers(elements, offsets)
    union = np.unique(elements)
    assert (neardup.merged(made[0], made[1]) == neardup.registers(union, np.array([0, len(union)]))[0]).all()
    x, y = shingles(text(left)), shingles(text(right))
    n = np.diff(offsets)
    found = neardup.estimate(n[:1], n[1:], made[:1], made[1:])[0]
    assert abs(found - len(x & y) / len(x | y)) < 0.12


def test_common_counts_equal_intersections(monkeypatch):
    monkeypatch.setattr(neardup, "COLUMNS", 16)
    draw = np.random.default_rng(2)
    sets = [np.unique(draw.integers(0, 200, n)).astype(np.uint64) for n in (1, 5, 80, 150, 0, 40)]
    got = neardup.common_counts(sets[:4], sets[2:])
    assert got.tolist() == [[len(np.intersect1d(x, y)) for y in sets[2:]] for x in sets[:4]]


def test_contract_maps_to_the_least_node(spark):
    edges = spark.createDataFrame([(5, 4), (4, 9), (9, 2), (7, 8), (8, 7)], "x long, y long")
    roots = {r["node"]: r["root"] for r in neardup.contract(edges.select(F.col("x"), F.col("y"))).collect()}
    assert roots == {5: 2, 4: 2, 9: 2, 2: 2, 7: 7, 8: 7}


def test_long_words_that_differ_by_powers_of_two_are_different(spark, frame):
    """The Thue-Morse word and its complement: equal polynomials modulo 2^64 for every odd base."""
    for size in (1024, 2048, 4096):
        word = "".join("ab"[bin(i).count("1") % 2] for i in range(size))
        other = word.translate(str.maketrans("ab", "ba"))
        docs = [(1, f"{word} x y z"), (2, f"{other} x y z"), (3, f"{word.upper()}  x y z")]
        found = {r.doc_id: r.component_id for r in neardup.near_duplicates(frame(docs), percent=85, size=3).collect()}
        assert found == {1: 1, 2: 2, 3: 1}


def test_digests_follow_the_words_alone():
    texts = ["Ab  c", " ab c\t", "ab c d", "abc", "", None, "a bc", "é É"]
    (words,) = word_runs(pa.array(texts), SPACED)
    made = neardup.digests_of(words)
    assert made[0] == made[1] and made[4] == made[5] and len(set(made)) == 6


def test_alike_equals_brute_force():
    draw = random.Random(8)
    texts = [None, "", "  ", "a", "A", "a b", "b a", "a b c", "a a a a a", "a a a a", "é x é x y"]
    for n in (3, 4, 6, 30, 200):
        base = [f"w{draw.randint(0, n)}" for _ in range(n)]
        for changes in (0, 1, 1, 2, 5):
            other = list(base)
            for _ in range(changes):
                other[draw.randrange(n)] = draw.choice(["w1", "new", "W2"])
            texts.append("  ".join(other))
    column, found = pa.array(texts), 0
    for size, percent in ((3, 85), (5, 80), (1, 50)):
        for i, left in enumerate(texts):
            for j, right in enumerate(texts):
                x, y = shingles(left, size), shingles(right, size)
                want = bool(x & y) and 100 * len(x & y) >= percent * len(x | y)
                assert neardup.alike(column.slice(i, 1), column.slice(j, 1), percent, size) == want, (left, right, size)
                found += want
    assert found > 50


def test_equal_hashes_of_different_words_link_nothing(monkeypatch):
    """All hashes equal: only the words tell the texts apart."""
    monkeypatch.setattr("retain.llm.words.span_hashes", lambda data, starts, ends: np.ones(len(starts), np.uint64))
    texts = ["a b c d", "e f g h", "a b c d", "a b c d e f g"]
    block = pa.table({"few": [True, True, False, False], "cls": [1, 2, 3, 4], "comp": [1, 2, 3, 4], "text": texts})
    links = neardup.linked_rows(85, 3)(block).to_pylist()
    assert links == [{"a": 1, "b": 3}]


def test_pieces_cover_all_rows_in_bounded_runs():
    texts = ["x" * 300, None, "", "y" * 5000, "é" * 400, None] * 20
    for column in (pa.array(texts), pa.array(["z", *texts]).slice(1), pa.array([], pa.string())):
        cut = list(pieces(column, 1000))
        assert [t for piece in cut for t in piece.to_pylist()] == column.to_pylist()
        assert all(len(piece) == 1 or sum(len((t or "").encode()) for t in piece.to_pylist()) <= 1000 for piece in cut)


def test_a_worker_holds_few_texts_at_once(frame, monkeypatch):
    """Of 12 MB in one partition no batch is much over 4 MB, and a sketch returns run by run."""

    def measured(text, size):
        def make(batches):
            for texts in batches:
                assert texts.nbytes < 6 << 20, f"{texts.nbytes} bytes in a batch"
                yield pa.StructArray.from_arrays(
                    [pa.array([b"x"] * len(texts)), pa.array([0] * len(texts)), pa.nulls(len(texts), pa.binary())], ["digest", "n", "registers"]
                )

        make.__annotations__ = {"batches": neardup.Iterator[pa.Array], "return": neardup.Iterator[pa.Array]}
        return F.arrow_udf(make, neardup.SKETCH)(text)

    docs = frame([(i, str(i)) for i in range(40)]).coalesce(1).withColumn("text", F.repeat(F.lit("ab "), 100_000))
    with monkeypatch.context() as patch:
        patch.setattr(neardup, "sketch", measured)
        assert neardup.Finder(docs, 80, 5).rows.count() == 40
    held = []
    monkeypatch.setattr(neardup.F, "arrow_udf", lambda make, kind: lambda text: held.extend(len(x) for x in make(iter([pa.array(["ab " * 10_000] * 100)]))))
    neardup.sketch(None, 5)
    assert sum(held) == 100 and max(held) < 20
