"""Exact interpolated quantiles without gathering a column in one task.

`percentile` keeps every distinct value of a group in one map, which does not scale. Here
passes narrow each wanted rank down: a coarse mergeable sketch gives a value range around it;
one aggregation counts the rows between the ranges and in equal-width bins inside them; the bin
that holds a wanted rank is cut again between its own least and greatest value, which closes
gaps and tails that made it hold too much; a last pass counts the values of what is left. Ranks
come from these exact counts alone, so a poor sketch can cost time but not change a result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BINS = 1024


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    fractions: Sequence[float],
    *,
    by: Sequence[str] = (),
    accuracy: int = 1000,
    refinements: int = 1,
) -> DataFrame:
    """Linear-interpolated quantiles of each column, nulls ignored.

    Returns one row (or one per group of the low-cardinality keys `by`) with an
    `array<double>` per column, in the order of `fractions`. A column without values gives
    null, or no row if it is the only one. `df` is read 3 + `refinements` times. The sketch of a
    task is a few kB; the bins of a column are at most `BINS` rows per fraction; the values
    sorted at the end are those of single bins, about 4 / accuracy / BINS of the rows and again
    1 / BINS of that with every refinement.
    """
    by, group = list(by), [*by, "_metric"]
    positions = [f"(_n - 1) * {float(p)!r}D" for p in fractions]
    cells = [f"struct('{c}' AS _metric, CAST(`{c}` AS DOUBLE) AS _x)" for c in columns]
    # A row per cell, also of a single column: a constant key would make the joins below cross joins.
    long = (
        df.select(*by, F.expr(f"explode(array({', '.join(cells)}))").alias("_e")).select(*by, "_e.*").filter("_x IS NOT NULL")
    )

    # Pass 1: a value range [low, high] around each fraction.
    margin = 2.0 / accuracy
    marks = [m for p in fractions for m in (max(p - margin, 0.0), min(p + margin, 1.0))]
    sketch = long.groupBy(*group).agg(F.percentile_approx("_x", marks, accuracy).alias("_marks"))
    ranges = [(f"_marks[{2 * i}]", f"_marks[{2 * i + 1}]") for i in range(len(positions))]

    # Pass 2: rows per bin, and rows per gap between ranges. Both are intervals of values,
    # disjoint and in order, so running totals give the ranks each one holds.
    bins = [
        f"WHEN _x BETWEEN {low} AND {high} THEN struct({i} AS range, CAST(coalesce(least("
        f"floor(try_divide(_x - {low}, {high} - {low}) * {BINS}), {BINS - 1}), 0) AS INT) AS bin)"
        for i, (low, high) in enumerate(ranges)
    ]
    passed = " + ".join(f"CAST(_x > {high} AS INT)" for _, high in ranges)
    interval = f"CASE {' '.join(bins)} ELSE struct(-1 AS range, {passed} AS bin) END"
    whole = Window.partitionBy(*group)
    running = whole.orderBy("_low").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        _attach(long, sketch, group)
        .select(*group, "_x", F.expr(interval).alias("_interval"))
        .groupBy(*group, "_interval")
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("_x").alias("_low"), F.max("_x").alias("_high"))
        .select(
            *group, "_low", "_high", "_rows",
            F.sum("_rows").over(running).alias("_end"),
            F.sum("_rows").over(whole).alias("_n"),
        )
    )
    ranks = ", ".join(
        f"struct({2 * i} AS slot, floor({q}) AS rank), struct({2 * i + 1} AS slot, ceil({q}) AS rank)"
        for i, q in enumerate(positions)
    )
    held = f"filter(array({ranks}), r -> r.rank >= _end - _rows AND r.rank < _end)"
    wanted = (
        ranked.select(
            *group, "_n", "_low", "_high", F.expr("_end - _rows").alias("_start"),
            F.expr(f"explode({held})").alias("_t"),
        )
        .groupBy(*group, "_n")
        .agg(F.expr("collect_list(struct(_low, _high, _start, _t.slot, _t.rank))").alias("_wanted"))
    )

    # Further passes: the same inside the intervals that hold a wanted rank.
    for _ in range(refinements):
        wanted = _refined(_inside(long, wanted, group, len(positions)), group)

    # Last pass: the values of the intervals that are left.
    inside = Window.partitionBy(*group, "slot").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        _inside(long, wanted, group, len(positions))
        .groupBy(*group, "_n", "slot", "rank", "_start", "_x")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_end", F.col("_start") + F.sum("_rows").over(inside))
        .filter("rank < _end AND rank >= _end - _rows")
    )
    results = []
    for i, q in enumerate(positions):
        low = f"max(CASE WHEN slot = {2 * i} THEN _x END)"
        high = f"max(CASE WHEN slot = {2 * i + 1} THEN _x END)"
        share = q.replace("_n", "max(_n)")
        results.append(f"{low} + ({high} - {low}) * ({share} - floor({share}))")
    arrays = found.groupBy(*group).agg(F.expr(f"array({', '.join(results)})").alias("_q"))
    if len(columns) == 1:
        return arrays.select(*by, F.col("_q").alias(columns[0]))
    return arrays.groupBy(*by).agg(
        *[F.max(F.when(F.col("_metric") == c, F.col("_q"))).alias(c) for c in columns]
    )


def _inside(long: DataFrame, wanted: DataFrame, group: list[str], fractions: int) -> DataFrame:
    """The rows in wanted intervals, once per interval. The first filter drops almost every row
    with plain comparisons."""
    any_interval = " OR ".join(
        f"_x BETWEEN get(_wanted, {i})._low AND get(_wanted, {i})._high" for i in range(2 * fractions)
    )
    return (
        _attach(long, wanted, group)
        .filter(any_interval)
        .select(*group, "_n", "_x", F.expr("inline(filter(_wanted, w -> _x BETWEEN w._low AND w._high))"))
    )


def _refined(rows: DataFrame, group: list[str]) -> DataFrame:
    """Every wanted interval narrowed to the one of its `BINS` parts that holds the rank."""
    part = f"CAST(coalesce(least(floor(try_divide(_x - _low, _high - _low) * {BINS}), {BINS - 1}), 0) AS INT)"
    slot = [*group, "_n", "slot", "rank"]
    parts = rows.groupBy(*slot, "_start", F.expr(part).alias("_part")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_x").alias("_low"), F.max("_x").alias("_high")
    )
    running = Window.partitionBy(*group, "slot").orderBy("_low").rowsBetween(Window.unboundedPreceding, 0)
    return (
        parts.withColumn("_end", F.col("_start") + F.sum("_rows").over(running))
        .filter("rank < _end AND rank >= _end - _rows")
        .groupBy(*group, "_n")
        .agg(F.expr("collect_list(struct(_low, _high, _end - _rows AS _start, slot, rank))").alias("_wanted"))
    )


def _attach(long: DataFrame, small: DataFrame, group: list[str]) -> DataFrame:
    """Put a group's row next to its values. `small` has one short row per group and column;
    the groups are few by contract."""
    renamed = {g: f"_k{i}" for i, g in enumerate(group)}
    same = reduce(
        lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(k)) for g, k in renamed.items()]
    )
    return long.join(F.broadcast(small.withColumnsRenamed(renamed)), same).drop(*renamed.values())
