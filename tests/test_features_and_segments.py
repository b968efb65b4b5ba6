import datetime as dt
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from retain import Config
from retain.functions.intervals import interpolated, interval_quantiles
from retain.operators import features, migration, segmentation

DAY = dt.date(2024, 3, 31)
ORDER = "order_id string, customer_id string, product_id string, order_date date, total_amount double, order_status string, channel string"


def orders(spark, rows):
    return spark.createDataFrame(
        [(str(i), c, p, d, a, s, ch) for i, (c, p, d, a, s, ch) in enumerate(rows)], ORDER
    )


def test_single_order_and_churn_boundary(spark):
    df = orders(spark, [
        ("one", "p", DAY - dt.timedelta(90), 100.0, "Completed", "Web"),
        ("late", "p", DAY - dt.timedelta(91), 10.0, "Completed", "Web"),
        ("one", "p", DAY, 999.0, "Cancelled", "Web"),
        (None, "p", DAY, 7.0, "Completed", "Web"),
    ])
    table = features.build_churn_flag(features.build_clv(features.build_rfm(df)))
    got = {r.customer_id: r for r in table.collect()}
    assert set(got) == {"one", "late"}
    one = got["one"]
    assert (one.avg_order_value, one.purchase_frequency, one.clv) == (100.0, 30.0, 36000.0)
    assert (one.recency_days, one.churned, got["late"].churned) == (90, 0, 1)


def test_customer_without_purchase_and_mode_ties(spark):
    customers = spark.createDataFrame(
        [("a", dt.date(2024, 3, 1)), ("never", dt.date(2024, 3, 21))],
        "customer_id string, registration_date date",
    )
    df = orders(spark, [("a", p, DAY, 1.0, "Completed", c) for p, c in (("1", "z"), ("2", "b"), ("1", "z"), ("2", "b"))]
                + [("x", "unknown", DAY, 1.0, "Completed", None)])
    items = spark.createDataFrame([("1", "zoo"), ("2", "art")], "product_id string, category string")
    reviews = spark.createDataFrame([("a", 5, "r")], "customer_id string, rating int, review_id string")
    got = {r.customer_id: r for r in features.build_customer_features(customers, df, items, reviews).collect()}
    assert (got["a"].favourite_category, got["a"].preferred_channel) == ("art", "b")
    never = got["never"]
    assert (never.churned, never.recency_days, never.frequency, never.monetary) == (1, 10, 0, 0.0)
    assert (never.favourite_category, never.preferred_channel, never.last_order_date) == ("None", "None", None)
    x = features.build_category_features(df, items).filter("customer_id = 'x'").first()
    assert (x.favourite_category, x.preferred_channel) == ("Unknown", "Unknown")


def expected_segment(r, f, m):
    if min(r, f, m) >= 4:
        return "Champions"
    if min(f, m) >= 4:
        return "Loyal Customers"
    if r >= 4 and f <= 2:
        return "New Customers"
    if r <= 2 and f >= 3:
        return "At Risk"
    return "Lost" if r + f + m <= 5 else "Potential Loyalists"


def test_segment_rules_for_every_score(spark):
    triples = list(product(range(1, 6), repeat=3))
    df = spark.createDataFrame(triples, "r int, f int, m int")
    got = df.withColumn("s", segmentation.segment_of(F.col("r"), F.col("f"), F.col("m"))).collect()
    assert all(row.s == expected_segment(row.r, row.f, row.m) for row in got)


def test_scores_count_the_edges_below(spark):
    rng = np.random.default_rng(3)
    data = [(i, int(rng.integers(0, 400)), int(rng.integers(0, 4)), float(np.round(rng.lognormal(4, 1), 2))) for i in range(500)]
    df = spark.createDataFrame(data, "customer_id int, recency_days int, frequency int, monetary double")
    got = {r.customer_id: r for r in segmentation.rfm_scores(df).collect()}
    columns = list(zip(*data))
    edges = [np.quantile(c, [0.2, 0.4, 0.6, 0.8]) for c in columns[1:]]
    for i, recency, frequency, monetary in data:
        r, f, m = (int(1 + (v > np.round(e, 6)).sum()) for v, e in zip((recency, frequency, monetary), edges))
        assert (got[i].R_score, got[i].F_score, got[i].M_score) == (6 - r, f, m)
    counts = segmentation.value_counts(segmentation.rfm_segmentation(df), "rfm_segment").collect()
    assert sum(r.customers for r in counts) == 500


def test_migration_moves_by_hand(spark):
    assert migration.last_month_end(dt.date(2024, 3, 31)) == dt.date(2024, 3, 31)
    assert migration.last_month_end(dt.date(2024, 1, 15)) == dt.date(2023, 12, 31)
    df = orders(spark, [(c, "p", d, 5.0, "Completed", "Web") for c, d in (
        ("old", dt.date(2024, 1, 5)), ("old", dt.date(2024, 3, 5)), ("new", dt.date(2024, 3, 9)))])
    states = migration.customer_states(df, Config())
    rows = {(r.customer_id, r.month, r.until): (r.frequency, r.monetary, r.before and r.before.frequency) for r in states.collect()}
    m = 2024 * 12
    assert rows == {("old", m + 1, m + 2): (1, 5.0, None), ("old", m + 3, m + 3): (2, 10.0, 1), ("new", m + 3, m + 3): (1, 5.0, None)}
    moves = sorted((r.month, r.customers) for r in migration.segment_migration(states).collect())
    assert moves == [("2024-02", 1), ("2024-03", 1)]


def test_interval_quantiles_equal_those_of_the_expanded_rows(spark):
    draw = np.random.default_rng(7)
    n = 4000
    start = draw.integers(1, 40, n)
    until = np.minimum(start + draw.integers(0, 15, n), 45)
    odd = np.where(draw.random(n) < 0.3, 1000.0, np.round(draw.normal(0, 5000, n), 2))
    near = 1_000_000 + np.round(draw.random(n), 6)  # all in one first bin
    rows = [(int(a), int(b), float(x), float(y)) for a, b, x, y in zip(start, until, odd, near)]
    df = spark.createDataFrame([*rows, (3, 4, None, None)], "a int, b int, odd double, near double")
    fractions = (0.0, 0.2, 0.5, 0.8, 1.0)
    got = {
        (r.metric, r.month): r.q
        for r in interval_quantiles(df, ["odd", "near"], "a", "b", fractions)
        .withColumn("q", interpolated(F.col("n"), F.col("values"), fractions)).collect()
    }
    for metric, values in (("odd", odd), ("near", near)):
        for month in range(1, 46):
            valid = values[(start <= month) & (until >= month)]
            assert got.pop((metric, month)) == pytest.approx(np.quantile(valid, fractions), rel=1e-12)
    assert not got


def test_migration_keeps_no_row_per_buyer_and_month(spark):
    """Buyers who never return: runs, not months, leave their rows."""
    df = orders(spark, [(str(i), "p", dt.date(2014, 1 + i % 12, 3), 5.0 + i, "Completed", "Web") for i in range(200)])
    states = migration.customer_states(df, Config())
    months = sum(r.until - r.month + 1 for r in states.collect())
    assert states.count() == 200 and months > 20_000
    assert migration.moves(states).count() < months / 10
    total = sum(r.customers for r in migration.segment_migration(states).collect())
    assert total == months - 200
