"""Quintile scores, named segments and the tables about them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retain.functions.numeric import clip, ratio, round_half_even, sum_money
from retain.functions.quantiles import exact_quantiles
from retain.functions.rows import with_row

QUINTILES = (0.2, 0.4, 0.6, 0.8)

# Score -> the column it is taken from, and whether low values score high.
SCORES = {
    "R_score": ("recency_days", True),
    "F_score": ("frequency", False),
    "M_score": ("monetary", False),
}


def score_from_edges(value: Column, edges: Column, descending: bool = False) -> Column:
    """1 + the number of inner edges below the value: quantile bins closed on the right.

    Equal edges skip a score, so the result is defined for any distribution.
    """
    above = [
        (value > F.get(edges, F.lit(i))).cast("int")
        for i in range(len(QUINTILES))
    ]
    score = F.lit(1) + reduce(lambda a, b: a + b, above)
    return F.lit(len(QUINTILES) + 2) - score if descending else score


def segment_of(r: Column, f: Column, m: Column) -> Column:
    """Named segment of a score triple; the first rule that holds decides."""
    # Segment names, their order and score limits.
    rules = [
        ("Champions", (r >= 4) & (f >= 4) & (m >= 4)),
        ("Loyal Customers", (f >= 4) & (m >= 4)),
        ("New Customers", (r >= 4) & (f <= 2)),
        ("At Risk", (r <= 2) & (f >= 3)),
        ("Lost", r + f + m <= 5),
    ]
    chain = reduce(lambda acc, rule: acc.when(rule[1], rule[0]), rules, F)
    return chain.otherwise("Potential Loyalists")


def rfm_edges(feat: DataFrame) -> DataFrame:
    """One row: the four inner quintile edges of recency, frequency and monetary value."""
    inputs = feat.select(
        "recency_days",
        clip(F.col("frequency"), 0).alias("frequency"),
        clip(F.col("monetary"), 0.0).alias("monetary"),
    )
    return exact_quantiles(inputs, ["recency_days", "frequency", "monetary"], QUINTILES)


def rfm_scores(feat: DataFrame) -> DataFrame:
    """Adds R, F and M scores from 1 to 5 and their sum.

    The edges are one row, so scoring needs no sort of the customers. `feat` is read four
    times: give it a materialized table when it is costly.
    """
    scores = {
        score: score_from_edges(F.col(column), F.col(f"_edges.{column}"), descending)
        for score, (column, descending) in SCORES.items()
    }
    return (
        with_row(feat, "_edges", rfm_edges(feat))
        .withColumns(scores)
        .withColumn("RFM_score", F.col("R_score") + F.col("F_score") + F.col("M_score"))
        .drop("_edges")
    )


def rfm_segmentation(feat: DataFrame) -> DataFrame:
    return rfm_scores(feat).withColumn(
        "rfm_segment", segment_of(F.col("R_score"), F.col("F_score"), F.col("M_score"))
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows and share per value, most frequent first; nulls are left out."""
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("customers"))
    )
    total = df.agg(F.count(F.lit(1))).scalar()
    share = round_half_even(ratio(F.col("customers"), total) * 100, 4)
    return counts.select(column, "customers", share.alias("pct")).orderBy(F.desc("customers"), column)


def clv_by_segment(segmented: DataFrame, active_only: bool = False) -> DataFrame:
    """Mean and total lifetime value per segment; `active_only` keeps clv > 0."""
    rows = segmented.filter("clv > 0") if active_only else segmented
    total = sum_money(F.col("clv"))
    return (
        rows.groupBy("rfm_segment")
        .agg(
            round_half_even(ratio(total, F.count("clv")), 2).alias("avg_clv"),
            round_half_even(total, 2).alias("total_clv"),
        )
        .orderBy(F.desc("avg_clv"), "rfm_segment")
    )


def segment_summary(segmented: DataFrame) -> DataFrame:
    def mean_money(column: str) -> Column:
        return round_half_even(ratio(sum_money(F.col(column)), F.count(column)), 2)

    return (
        segmented.groupBy("rfm_segment")
        .agg(
            F.count("customer_id").alias("customers"),
            round_half_even(F.avg("recency_days"), 2).alias("avg_recency"),
            round_half_even(F.avg("frequency"), 2).alias("avg_frequency"),
            mean_money("monetary").alias("avg_monetary"),
            mean_money("clv").alias("avg_clv"),
            round_half_even(F.avg("churned"), 2).alias("churn_rate"),
        )
        .orderBy(F.desc("avg_clv"), "rfm_segment")
    )


def churn_by_segment(segmented: DataFrame) -> DataFrame:
    return (
        segmented.groupBy("rfm_segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum("churned").alias("churned"),
            round_half_even(F.avg("churned") * 100, 4).alias("churn_pct"),
        )
        .orderBy("rfm_segment")
    )


def rfm_scatter(segmented: DataFrame, n: int = 500, order: Column | None = None, seed: int = 42) -> DataFrame:
    """A repeatable sample of n buyers: those that come first in a hash order."""
    key = F.xxhash64(F.lit(seed), F.col("customer_id")) if order is None else order
    return (
        segmented.filter("monetary > 0")
        .orderBy(key, "customer_id")
        .limit(n)
        .select("customer_id", "recency_days", "monetary", "rfm_segment")
    )
