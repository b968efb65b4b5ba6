"""Descriptive statistics, histograms, correlations and the Welch test."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retain.config import DEFAULT, HEATMAP_COLUMNS, NUMERIC_FEATURES, TARGET, Config
from retain.functions.numeric import ratio, round_half_even
from retain.functions.quantiles import exact_quantiles
from retain.functions.ranks import RankedValues
from retain.functions.rows import add_row, with_row
from retain.functions.special import two_sided_p


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum, one row per column."""
    stats = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("count"),
                round_half_even(F.avg(c), 6).alias("mean"),
                round_half_even(F.stddev_samp(c), 6).alias("std"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).select(
        *[F.col(c).alias(f"_q_{c}") for c in columns]
    )
    entries = [F.struct(f"{c}.*", F.col(f"_q_{c}").alias("q")) for c in columns]
    return (
        add_row(stats, quartiles)
        .select(F.explode(F.array(*entries)).alias("e"))
        .select("e.*")
        .select(
            "column_name", "count", "mean", "std", "min",
            *[
                round_half_even(F.get("q", F.lit(i)), 6).alias(name)
                for i, name in enumerate(("p25", "p50", "p75"))
            ],
            "max",
        )
    )


def histogram(df: DataFrame, column: str, bins: int, cap_at: float | None = None) -> DataFrame:
    """Equal-width bins over the value range, the last one closed; empty bins are listed too.

    `cap_at` first limits values to that quantile.
    """
    values = df.select(F.col(column).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    if cap_at is not None:
        cap = exact_quantiles(values, ["_x"], [cap_at]).select(F.get("_x", F.lit(0)).alias("_cap"))
        values = values.select(F.least(F.col("_x"), cap.scalar()).alias("_x"))
    span = values.agg(F.min("_x").alias("_min"), F.max("_x").alias("_max"))
    flat = F.col("_min") == F.col("_max")
    span = span.select(
        F.when(flat, F.col("_min") - 0.5).otherwise(F.col("_min")).alias("_from"),
        F.when(flat, F.col("_max") + 0.5).otherwise(F.col("_max")).alias("_to"),
    ).withColumn("_width", (F.col("_to") - F.col("_from")) / bins)
    offset = (F.col("_x") - F.col("_span._from")) / F.col("_span._width")
    bin_of = F.least(F.floor(offset), F.lit(bins - 1)).cast("int")
    counts = (
        with_row(values, "_span", span)
        .select(bin_of.alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    edges = span.select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "_from", "_width"
    )
    # As many rows as bins.
    return edges.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        round_half_even(F.col("_from") + F.col("_width") * F.col("bin"), 4).alias("bin_from"),
        round_half_even(F.col("_from") + F.col("_width") * (F.col("bin") + 1), 4).alias("bin_to"),
        F.coalesce("n", F.lit(0)).alias("customers"),
    )


def box_plot(df: DataFrame, group: str, column: str) -> DataFrame:
    """Five-number summary per group, with whiskers at the last value within 1.5 IQR.

    Groups may be many or large: values are counted and ranked by ranges, and meet their group's
    quartiles once per group and range.
    """
    ranked = RankedValues(df, group, column)
    q = ranked.quantiles([0.0, 0.25, 0.5, 0.75, 1.0])
    reach = (F.get("q", F.lit(3)) - F.get("q", F.lit(1))) * 1.5
    limits = q.select(group, (F.get("q", F.lit(1)) - reach).alias("_low"), (F.get("q", F.lit(3)) + reach).alias("_high"))
    x = F.col("_x")
    whiskers = (
        ranked.with_parts(ranked.parts().select(group, "_range").join(limits, group))
        .groupBy(group)
        .agg(
            F.min(F.when(x >= F.col("_low"), x)).alias("whisker_low"), F.max(F.when(x <= F.col("_high"), x)).alias("whisker_high"),
        )
    )
    summary = q.select(
        group,
        *[
            round_half_even(F.get("q", F.lit(i)), 6).alias(name)
            for i, name in enumerate(("min", "q1", "median", "q3", "max"))
        ],
        F.col("n").alias("customers"),
    )
    return summary.join(whiskers, group)


def pearson(a: str, b: str) -> Column:
    """Correlation over the rows where both are present; null if either is constant."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    sd_x = F.stddev_pop(F.when(y.isNotNull(), x))
    sd_y = F.stddev_pop(F.when(x.isNotNull(), y))
    return ratio(F.covar_pop(x, y), sd_x * sd_y)


def correlation_with(df: DataFrame, target: str, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """Correlation of each present column with the target, lowest first, in one pass."""
    present = [c for c in columns if c in df.columns]
    row = df.agg(*[round_half_even(pearson(c, target), digits).alias(c) for c in present])
    entries = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("correlation")) for c in present]
    return (
        row.select(F.explode(F.array(*entries)).alias("e"))
        .select("e.*")
        .orderBy("correlation", "feature")
    )


def correlation_analysis(feat: DataFrame) -> DataFrame:
    return correlation_with(feat, TARGET, NUMERIC_FEATURES).withColumnRenamed(
        "correlation", "correlation_with_churn"
    )


def correlation_matrix(
    df: DataFrame, columns: Sequence[str] = HEATMAP_COLUMNS, digits: int = 4
) -> DataFrame:
    """Lower triangle of the correlation matrix as (row, column, correlation), in one pass."""
    present = [c for c in columns if c in df.columns]
    pairs = [(b, a) for a, b in combinations(present, 2)]
    row = df.agg(
        *[round_half_even(pearson(a, b), digits).alias(f"_{i}") for i, (a, b) in enumerate(pairs)]
    )
    entries = [
        F.struct(
            F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"_{i}").alias("correlation")
        )
        for i, (a, b) in enumerate(pairs)
    ]
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def welch(feat: DataFrame, column: str = "monetary", flag: str = TARGET, alpha: float = DEFAULT.alpha) -> DataFrame:
    """Welch's test of flag = 1 against flag = 0, one row. A test that is not defined is not significant."""
    x = F.col(column).cast("double")
    parts = []
    for name, value in (("a", 1), ("b", 0)):
        inside = F.when(F.col(flag) == value, x)
        parts += [
            F.count(inside).alias(f"n_{name}"),
            F.avg(inside).alias(f"mean_{name}"),
            F.var_samp(inside).alias(f"var_{name}"),
        ]
    row = feat.agg(*parts)
    se_a = ratio(F.col("var_a"), F.col("n_a"))
    se_b = ratio(F.col("var_b"), F.col("n_b"))
    spread = se_a + se_b
    t = ratio(F.col("mean_a") - F.col("mean_b"), F.sqrt(spread))
    freedom = ratio(
        spread * spread,
        ratio(se_a * se_a, F.col("n_a") - 1) + ratio(se_b * se_b, F.col("n_b") - 1),
    )
    # Written out once, as the p-value uses them many times.
    tested = row.select("*", t.alias("_t"), freedom.alias("_df")).select("*", two_sided_p(F.col("_t"), F.col("_df")).alias("_p"))
    return tested.select(
        round_half_even(F.col("_t"), 4).alias("t_statistic"),
        round_half_even(F.col("_df"), 4).alias("degrees_of_freedom"),
        round_half_even(F.col("_p"), 6).alias("p_value"),
        F.coalesce(F.col("_p") < alpha, F.lit(False)).alias("significant"),
        round_half_even(F.col("mean_a"), 2).alias("churned_mean"),
        round_half_even(F.col("mean_b"), 2).alias("retained_mean"),
        F.col("n_a").alias("churned_n"),
        F.col("n_b").alias("retained_n"),
    )


def hypothesis_test(feat: DataFrame, config: Config = DEFAULT) -> dict[str, object]:
    """The row of Welch's test as a dictionary."""
    row = welch(feat, alpha=config.alpha).first()
    wanted = ("t_statistic", "p_value", "significant", "churned_mean", "retained_mean")
    return {"test": "Welch's t-test of monetary value, churned against retained"} | {name: row[name] for name in wanted}
