"""KPI cards, funnel, lifetime-value tables and the summary of findings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retain.config import DEFAULT, Config
from retain.functions.numeric import MONEY_TYPE, ratio, round_half_even, sum_money
from retain.functions.rows import add_row
from retain.operators.features import completed_orders
from retain.operators.retention import avg_retention
from retain.operators.revenue import category_sales, mom_growth


def _mean_money(col: Column) -> Column:
    return ratio(sum_money(col), F.count(col))


def kpis(segmented: DataFrame, orders: DataFrame, reviews: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """The KPI cards as one row."""
    revenue = sum_money(F.col("total_amount"))
    sales = completed_orders(orders, config).agg(
        round_half_even(revenue, 2).alias("total_revenue"),
        round_half_even(ratio(revenue, F.count("order_id")), 2).alias("avg_order_value"),
    )
    base = segmented.agg(
        F.count_if(F.col("churned") == 0).alias("active_customers"),
        round_half_even(F.avg(F.when(F.col("churned") == 0, 1.0).otherwise(0.0)) * 100, 4).alias("active_pct"),
        round_half_even(F.avg("churned") * 100, 4).alias("churn_rate_pct"),
        round_half_even(_mean_money(F.when(F.col("frequency") > 0, F.col("clv"))), 2).alias("avg_clv"),
        round_half_even(
            F.coalesce(sum_money(F.when(F.col("rfm_segment") == "At Risk", F.col("monetary"))), F.lit(0.0)), 2
        ).alias("revenue_at_risk"),
    )
    stars = reviews.agg(round_half_even(F.avg("rating"), 4).alias("avg_rating"))
    return add_row(add_row(sales, base), stars)


def kpi_targets(segmented: DataFrame, orders: DataFrame, reviews: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Each KPI against its target; `met` is null without a target or without a value."""
    growth = (
        mom_growth(orders, config)
        .orderBy(F.desc("month"))
        .limit(1)
        .agg(F.max("growth_pct").alias("revenue_growth_pct"))
    )
    retention = avg_retention(orders, config).select("avg_retention_rate")
    row = add_row(add_row(kpis(segmented, orders, reviews, config), growth), retention)
    # KPI, direction and target.
    targets = [
        ("revenue_growth_pct", ">=", 5.0),
        ("active_pct", ">", 60.0),
        ("churn_rate_pct", "<", 40.0),
        ("avg_clv", ">", 500.0),
        ("avg_order_value", ">", 100.0),
        ("avg_retention_rate", ">", 45.0),
        ("avg_rating", ">", 4.0),
        ("revenue_at_risk", "minimise", None),
    ]
    compare = {">=": Column.__ge__, ">": Column.__gt__, "<": Column.__lt__}

    def entry(name: str, direction: str, target: float | None) -> Column:
        met = F.lit(None).cast("boolean") if target is None else compare[direction](F.col(name), F.lit(target))
        return F.struct(
            F.lit(name).alias("kpi"),
            F.col(name).cast("double").alias("value"),
            F.lit(direction).alias("direction"),
            F.lit(target).cast("double").alias("target"),
            met.alias("met"),
        )

    return row.select(F.explode(F.array(*[entry(*t) for t in targets])).alias("e")).select("e.*")


def customer_funnel(feat: DataFrame) -> DataFrame:
    """Registered, at least one purchase, at least two, and churned customers."""
    row = feat.agg(
        F.count(F.lit(1)).alias("New"),
        F.count_if(F.col("frequency") >= 1).alias("Active"),
        F.count_if(F.col("frequency") >= 2).alias("Returning"),
        F.count_if(F.col("churned") == 1).alias("Churned"),
    )
    stages = [
        F.struct(F.lit(i + 1).alias("step"), F.lit(c).alias("stage"), F.col(c).alias("customers"))
        for i, c in enumerate(row.columns)
    ]
    return row.select(F.explode(F.array(*stages)).alias("e")).select("e.*")


def clv_vs_frequency(feat: DataFrame) -> DataFrame:
    return (
        feat.groupBy("frequency")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            round_half_even(_mean_money(F.col("clv")), 2).alias("avg_clv"),
        )
        .orderBy("frequency")
    )


def clv_projection(segmented: DataFrame) -> DataFrame:
    return segmented.select(
        "customer_id", "avg_order_value", "purchase_frequency", "clv", "rfm_segment"
    )


def top_customers_clv(segmented: DataFrame, n: int = 50) -> DataFrame:
    return clv_projection(segmented).orderBy(F.desc("clv"), "customer_id").limit(n)


def insights(
    segmented: DataFrame, orders: DataFrame, products: DataFrame,
    order_lines: DataFrame | None = None, config: Config = DEFAULT,
) -> DataFrame:
    """The findings of the whole analysis as one row. Ties go to the lowest name."""
    lines = orders if order_lines is None else order_lines
    done = completed_orders(orders, config)
    revenue = done.agg(round_half_even(sum_money(F.col("total_amount")), 2).alias("total_revenue"))
    champions = F.col("rfm_segment") == "Champions"
    spend = F.sum(F.col("monetary").cast(MONEY_TYPE))
    champion_spend = F.sum(F.when(champions, F.col("monetary").cast(MONEY_TYPE)))
    base = segmented.agg(
        round_half_even(F.avg("churned") * 100, 4).alias("churn_rate_pct"),
        round_half_even(_mean_money(F.when(F.col("clv") > 0, F.col("clv"))), 2).alias("avg_clv"),
        round_half_even(F.coalesce(ratio(champion_spend, spend), F.lit(0.0)) * 100, 4).alias(
            "champions_revenue_pct"
        ),
        round_half_even(_mean_money(F.when(champions, F.col("clv"))), 2).alias("champions_avg_clv"),
        F.count_if(F.col("rfm_segment") == "At Risk").alias("at_risk_customers"),
    )

    def first(df: DataFrame, by: str, column: str, name: str) -> DataFrame:
        return df.orderBy(F.desc(by), column).limit(1).select(F.col(column).alias(name))

    by_segment = segmented.groupBy("rfm_segment").agg(_mean_money(F.col("clv")).alias("_clv"))
    by_channel = done.dropna(subset=["channel"]).groupBy("channel").agg(F.count(F.lit(1)).alias("_n"))
    by_category = category_sales(lines, products, config)
    parts = [
        base,
        first(by_segment, "_clv", "rfm_segment", "top_segment_by_clv"),
        first(by_channel, "_n", "channel", "top_channel"),
        first(by_category, "purchases", "category", "top_category_by_purchases"),
        first(by_category, "revenue", "category", "top_category_by_revenue"),
    ]
    return reduce(add_row, parts, revenue)


def insight_sentences(findings: DataFrame, metrics: dict[str, float] | None = None) -> DataFrame:
    """The findings as numbered sentences; model quality is added when its metrics are given."""
    texts = [
        F.format_string(
            "%.1f%% of customers have churned; winning back the %d 'At Risk' customers comes first.",
            "churn_rate_pct", "at_risk_customers",
        ),
        F.format_string(
            "Champions bring %.0f%% of all spend with an average lifetime value of $%,.0f.",
            "champions_revenue_pct", "champions_avg_clv",
        ),
        F.format_string(
            "Completed orders earned $%,.0f; most of them came through '%s'.",
            "total_revenue", "top_channel",
        ),
        F.format_string(
            "The average lifetime value of buyers is $%,.2f, highest in the segment '%s'.",
            "avg_clv", "top_segment_by_clv",
        ),
        F.format_string(
            "'%s' is bought most often; '%s' earns most.",
            "top_category_by_purchases", "top_category_by_revenue",
        ),
    ]
    if metrics:
        texts.append(
            F.lit(
                f"The churn model reaches ROC-AUC {metrics['roc_auc']:.3f}, "
                f"accuracy {metrics['accuracy']:.1%} and recall {metrics['recall']:.1%}."
            )
        )
    return findings.select(F.posexplode(F.array(*texts)).alias("position", "sentence"))
