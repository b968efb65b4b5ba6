import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from retain.functions import clip, exact_quantiles, join_dimension, round_half_even
from retain.functions.joins import heavy_keys
from retain.functions.ranks import RankedValues
from retain.functions.special import log_gamma, two_sided_p
from retain.operators.statistics import box_plot

FRACTIONS = [0.0, 0.2, 0.25, 0.5, 0.75, 0.8, 0.95, 1.0]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (0,), (70,), (5,)], "x int")
    assert [r[0] for r in df.select(clip(F.col("x"), 1, 60)).collect()] == [None, 1, 60, 5]


def test_round_half_even(spark):
    df = spark.createDataFrame([(2.345,), (2.675,), (1.005,), (0.125,)], "x double")
    got = [r[0] for r in df.select(round_half_even(F.col("x"), 2)).collect()]
    assert got == [float(np.round(v, 2)) for v in (2.345, 2.675, 1.005, 0.125)]


@pytest.mark.parametrize("n", [1, 2, 7, 4000])
def test_quantiles_equal_numpy(spark, n):
    rng = np.random.default_rng(n)
    heavy = np.round(rng.lognormal(3, 3, n), 2)
    tied = rng.integers(0, 4, n)
    rows = [(float(a), int(b), i % 2) for i, (a, b) in enumerate(zip(heavy, tied))]
    df = spark.createDataFrame(rows, "heavy double, tied int, g int").repartition(5)
    row = exact_quantiles(df, ["heavy", "tied"], FRACTIONS, accuracy=50).first()
    assert np.allclose(row.heavy, np.quantile(heavy, FRACTIONS), rtol=1e-12)
    assert np.allclose(row.tied, np.quantile(tied, FRACTIONS), rtol=1e-12)
    for row in exact_quantiles(df, ["heavy"], FRACTIONS, by=["g"], accuracy=50).collect():
        mine = heavy[np.arange(n) % 2 == row.g]
        assert np.allclose(row.heavy, np.quantile(mine, FRACTIONS), rtol=1e-12)


def test_quantiles_with_one_dominant_value_and_nulls(spark):
    values = [5.0] * 3000 + [float(i) for i in range(1000)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 50, "x double")
    assert exact_quantiles(df, ["x"], FRACTIONS).first().x == pytest.approx(
        list(np.quantile(values, FRACTIONS))
    )


def test_quantiles_across_a_gap_stay_narrow(spark):
    low, high = [1 + i * 1e-9 for i in range(2000)], [1e6 + i * 1e-3 for i in range(2001)]
    df = spark.createDataFrame([(v,) for v in low + high], "x double")
    quantiles = exact_quantiles(df, ["x"], [0.25, 0.5], accuracy=20)
    assert quantiles.first().x == pytest.approx(list(np.quantile(low + high, [0.25, 0.5])), rel=1e-12)
    text = quantiles._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in text and "CartesianProduct" not in text


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([(None, None)], "x double, y double")
    assert exact_quantiles(empty, ["x"], [0.5]).collect() == []
    assert exact_quantiles(empty, ["x", "y"], [0.5]).first().x is None


@pytest.mark.parametrize("how", ["left", "inner"])
def test_join_with_hot_and_null_keys(spark, how):
    rows = [(i, 1 if i % 3 else i % 50, "a") for i in range(3000)]
    rows += [(3000 + i, None, "b") for i in range(500)]
    fact = spark.createDataFrame(rows, "id int, k int, v string")
    dim = spark.createDataFrame([(k, f"n{k}") for k in range(40)], "k int, name string")
    want = sorted(fact.join(dim, "k", how).collect(), key=str)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_dimension(fact, dim, "k", spread_by=["id"], how=how, salts=8, hot_keys=10)
        got = sorted(joined.select("k", "id", "v", "name").collect(), key=str)
        plan = joined._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == want
    assert "SortMergeJoin" in plan and "_salt" in plan


def test_student_p_values(spark):
    # Table values, and a normal limit.
    known = [(2.0, 10.0, 0.0733880, 1e-7), (1.0, 1.0, 0.5, 1e-9), (-1.959964, 1e9, 0.05, 1e-6), (0.0, 12.0, 1.0, 1e-12),
             (2.2281389, 10.0, 0.05, 1e-8), (12.7062047, 1.0, 0.05, 1e-9), (40.0, 5000.0, 0.0, 1e-12), (1e-3, 3.0, 0.9992649, 1e-6)]
    df = spark.createDataFrame([(i, t, v) for i, (t, v, _, _) in enumerate(known)], "i int, t double, v double")
    got = {r.i: r.p for r in df.select("i", two_sided_p(F.col("t"), F.col("v")).alias("p")).collect()}
    for i, (_, _, p, tolerance) in enumerate(known):
        assert got[i] == pytest.approx(p, abs=tolerance)
    absent = spark.createDataFrame([(None, 5.0), (1.0, None), (1.0, 0.0)], "t double, v double")
    assert [r.p for r in absent.select(two_sided_p(F.col("t"), F.col("v")).alias("p")).collect()] == [None] * 3


def test_log_gamma(spark):
    values = [0.5, 1.0, 2.5, 10.0, 1234.5, 1e7]
    got = spark.createDataFrame([(v,) for v in values], "z double").select(log_gamma(F.col("z"))).collect()
    assert [r[0] for r in got] == pytest.approx([math.lgamma(v) for v in values], rel=1e-13, abs=1e-13)


def test_ranked_values_of_many_and_of_large_groups(spark):
    draw = np.random.default_rng(9)
    rows = [("hot", float(v)) for v in np.round(draw.normal(0, 100, 20_000), 1)]
    rows += [(f"g{i % 3000:04d}", float(v)) for i, v in enumerate(draw.integers(0, 50, 9000))]
    df = spark.createDataFrame([*rows, (None, 1.0), ("none", None)], "g string, x double")
    ranked = RankedValues(df, "g", "x")
    got = ranked.quantiles([0.0, 0.25, 0.9, 1.0])
    groups = {}
    for g, x in rows:
        groups.setdefault(g, []).append(x)
    found = {r.g: (r.q, r.n) for r in got.collect()}
    assert set(found) == set(groups)
    for g, values in groups.items():
        assert found[g][1] == len(values) and found[g][0] == pytest.approx(np.quantile(values, [0, 0.25, 0.9, 1]), rel=1e-12)
    assert ranked.counts.filter("g = 'hot'").select("_range").distinct().count() > 1
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in box_plot(df, "g", "x")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_heavy_keys_are_those_above_the_mark(spark):
    rows = [(7,)] * 300 + [(None,)] * 150 + [(i,) for i in range(550)]
    df = spark.createDataFrame(rows, "k int")
    hot, nulls = heavy_keys(df, ["k"], 10)
    assert [r.k for r in hot.collect()] == [7] and nulls
    assert heavy_keys(df, ["k"], 5)[1] is False
    assert heavy_keys(df, ["k"], 3) == (None, False)
    assert heavy_keys(df.limit(0), ["k"], 10) == (None, False)
    two = df.withColumn("j", F.lit("x"))
    assert [tuple(r) for r in heavy_keys(two, ["k", "j"], 10)[0].collect()] == [(7, "x")]


def test_join_without_hot_keys_is_shuffled_once_for_a_later_grouping(spark):
    fact = spark.range(4000).selectExpr("id % 2000 AS k", "id AS line", "id % 3 AS v")
    dim = spark.range(2000).selectExpr("id AS k", "CAST(id AS STRING) AS name")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_dimension(fact, dim, "k", spread_by=["line"])
        grouped = joined.groupBy("k", "line").agg(F.max("name").alias("name"))
        text = grouped._jdf.queryExecution().executedPlan().toString()
        assert grouped.count() == 4000 and joined.filter("name IS NULL").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "_salt" not in text and text.count("Exchange hashpartitioning") == 2
