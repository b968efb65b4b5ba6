"""Hard negatives against all pairs, and the bounds that leave pairs out."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from cases import rows
from compare import connect, difference

from retain.llm import negatives
from retain.llm.queries import ORACLE, QUERIES

SCHEMA = "vec_id long, label int, vector array<float>, row string, score int, q string"
COLUMNS = "anchor_id positive_id rank negative_id positive_score negative_score".split()


def plain(vectors, every=100, n_positives=5, n_negatives=10):
    kept = [
        (i, v, str(label), [max(-(1 << 24), min(1 << 24, math.floor(256 * float(np.float32(x))))) for x in vec])
        for i, (v, label, vec) in enumerate(vectors)
        if label is not None and vec is not None and all(x is not None and math.isfinite(x) for x in vec)
    ]
    key = lambda r: (-r[0], r[1] is None, r[1] or 0, r[2])
    found = []
    for i, v, label, q in kept:
        if v is None or v % every:
            continue
        scored = [(sum(a * b for a, b in zip(q, p)), w, j, other) for j, w, other, p in kept if j != i]
        for positive in sorted([s for s in scored if s[3] == label], key=key)[:n_positives]:
            inside = [s for s in scored if s[3] != label and 30 * positive[0] <= 100 * s[0] <= 90 * positive[0]]
            for rank, s in enumerate(sorted(inside, key=key)[:n_negatives], 1):
                found.append((v, positive[1], rank, s[1], positive[0], s[0]))
    return sorted(found, key=repr)


def mined(spark, vectors, **kw):
    df = spark.createDataFrame([(*v, "r", 1, "q") for v in vectors], SCHEMA).repartition(3)
    return rows(negatives.mine(df, **kw), *COLUMNS)


def some(n, dims, n_labels, seed, shared=0):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(dims)] for _ in range(n_labels)]
    hot = [draw.gauss(0, 1) for _ in range(dims)]
    out = []
    for i in range(n):
        label = draw.randrange(n_labels)
        out.append((i, label, hot if i < shared else [c + draw.gauss(0, 0.7) for c in centres[label]]))
    return out


@pytest.mark.parametrize("dims, shared", [(64, 0), (100, 0), (16, 150), (3, 0)])
def test_equals_all_pairs(spark, dims, shared):
    vectors = some(500, dims, 6, dims, shared)
    assert mined(spark, vectors, every=25) == plain(vectors, every=25)


def test_blocks_of_rows_and_anchors_give_the_same(spark, monkeypatch):
    vectors = some(400, 32, 4, 5)
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 7)
    assert mined(spark, vectors, every=10) == plain(vectors, every=10)


def test_odd_rows(spark):
    vectors = some(120, 20, 3, 9)
    vectors += [
        (200, None, [1.0] * 20), (300, 1, None), (400, 1, [1.0, None] * 10), (500, 2, [math.nan] * 20), (600, 2, [math.inf] * 20),
        (700, 0, []), (800, 0, [1.0, 2.0]), (900, 1, [9.0] * 30), (None, 1, [0.5] * 20), (None, 1, [0.5] * 20), (1000, 1, [1e30] * 20),
        (0, 1, vectors[0][2]), (50, vectors[50][1], vectors[50][2]), (50, vectors[50][1], vectors[50][2]),
    ]
    assert mined(spark, vectors, every=10) == plain(vectors, every=10)


def test_empty_tables(spark):
    assert mined(spark, some(5, 4, 2, 1)[1:]) == []
    df = spark.createDataFrame([], SCHEMA)
    assert negatives.mine(df).collect() == []


def test_equals_sql_on_more_rows(spark):
    sf_dir = "/root/testdata/sf0.1"
    assert difference(QUERIES["op13_hard_negatives"](spark, sf_dir), connect(sf_dir), ORACLE["op13_hard_negatives"]) is None


def side(q, labels):
    columns = {
        "row": np.arange(len(q)), "vec_id": np.arange(len(q)), "label": [str(v) for v in labels],
        "q": negatives.as_lists(q, pa.int32()),
    }
    for width in negatives.WIDTHS:
        mean, dev = negatives.summary(q, width)
        columns |= {f"mean_{width}": negatives.as_lists(mean, pa.float64()), f"dev_{width}": negatives.as_lists(dev, pa.float64())}
    return negatives.Side(pa.table(columns))


def test_bounds_hold_and_narrow():
    draw = np.random.default_rng(3)
    q = draw.integers(-300, 300, (60, 130)).astype(np.int32)
    x = side(q, [0] * 60)
    i, j = (c.ravel() for c in np.indices((60, 60)))
    score, before = q[i].astype(np.int64) * q[j], None
    score = score.sum(axis=1)
    for mean, dev in x.levels:
        middle, room = negatives.products(mean, mean, i, j), negatives.products(dev, dev, i, j)
        assert (np.abs(score - middle) <= room + 1e-6).all()
        assert before is None or room.mean() < before
        before = room.mean()


def test_summaries_rule_pairs_out_before_they_are_scored():
    """Vectors of smooth segments: few pairs are left for exact scores."""
    draw = np.random.default_rng(4)
    q = np.repeat(draw.integers(-300, 300, (400, 8)), 16, axis=1).astype(np.int32) + draw.integers(-3, 3, (400, 128)).astype(np.int32)
    x = side(q, [0] * 400)
    i, j = (c.ravel() for c in np.indices((400, 400)))
    left, _ = negatives.bounded(x, x, i, j, lambda j, low, high: high >= negatives.kth_highest(j, low, 5, 400)[j])
    assert len(left) < len(i) / 20


def test_few_and_many_pairs_have_equal_products():
    draw = np.random.default_rng(5)
    x, y = draw.integers(-9, 9, (50, 12)).astype(float), draw.integers(-9, 9, (40, 10)).astype(float)
    i, j = (c.ravel() for c in np.indices((50, 40)))
    every = negatives.products(x, y, i, j)
    assert (negatives.products(x, y, i[::17], j[::17]) == every[::17]).all()
