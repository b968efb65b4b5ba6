"""Exact quantiles per month of values that hold from one month to another.

A row is a value with the months it is valid in. Nothing is repeated per month: a value adds one
where its interval starts and takes it away behind its end, sums of these are kept per month and
bin of values, and their running totals are the numbers of valid values. Bins are cut where wanted
ranks fall, until only the values of single parts are read. Tables after each first aggregation have
at most one row per bin and month, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PER_OCTAVE = 64  # bins of the first cut between a value and its double
PARTS = 1024  # of a bin that holds a wanted rank


def cumulated(changes: DataFrame, keys: Sequence[str], month: str, change: str, total: str, *others: str) -> DataFrame:
    """Changes per key and month to the running total of every month in which it is not zero.

    `changes` has one row per key and month; what a key's changes add up to must be zero.
    """
    order = Window.partitionBy(*keys).orderBy(month)
    running = F.sum(change).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    held = changes.select(*keys, *others, month, running.alias(total), (F.lead(month).over(order) - 1).alias("_to"))
    months = F.explode(F.sequence(F.col(month), F.col("_to"))).alias(month)
    return held.filter(f"{total} <> 0").select(*keys, *others, total, months)


def _valid(rows: DataFrame, keys: Sequence[str], start: str, until: str) -> DataFrame:
    """Per key and month how many rows are valid (`_n`), with the key's least and greatest value."""
    begin = F.struct(F.col(start).alias("_month"), F.lit(1).alias("_d"))
    end = F.struct((F.col(until) + 1).alias("_month"), F.lit(-1).alias("_d"))
    changes = (
        rows.select(*keys, "_x", F.explode(F.array(begin, end)).alias("_e"))
        .groupBy(*keys, "_e._month")
        .agg(F.sum("_e._d").alias("_d"), F.min("_x").alias("_least"), F.max("_x").alias("_most"))
    )
    whole = Window.partitionBy(*keys)
    changes = changes.withColumns({"_low": F.min("_least").over(whole), "_high": F.max("_most").over(whole)})
    return cumulated(changes, keys, "_month", "_d", "_n", "_low", "_high")


def _bin(x: str = "_x") -> str:
    return f"CAST(signum({x}) * floor(log2(abs({x}) + 1) * {PER_OCTAVE}) AS INT)"


def interval_quantiles(
    rows: DataFrame, columns: Sequence[str], start: str, until: str, fractions: Sequence[float]
) -> DataFrame:
    """For every column and month: (metric, month, n, values).

    `values` has two entries per fraction p, the values of rank floor and ceil((n - 1) * p) among
    those valid in the month. Nulls are ignored. `rows` is read three times. Between the passes
    there are two rows per column, fraction and month, so these are broadcast.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("_metric"), F.col(c).cast("double").alias("_x")) for c in columns])
    long = (
        rows.select(start, until, F.explode(cells).alias("_e")).select(start, until, "_e.*").filter("_x IS NOT NULL")
        .withColumn("_bin", F.expr(_bin()))
    )

    # Pass 1: valid values per bin and month; the bins that hold wanted ranks.
    month = Window.partitionBy("_metric", "_month")
    running = month.orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = _valid(long, ["_metric", "_bin"], start, until).withColumns(
        {"_end": F.sum("_n").over(running), "_total": F.sum("_n").over(month)}
    )
    positions = [f"(_total - 1) * {float(p)!r}D" for p in fractions]
    slots = ", ".join(
        f"struct({2 * i} AS _slot, floor({q}) AS _rank), struct({2 * i + 1} AS _slot, ceil({q}) AS _rank)"
        for i, q in enumerate(positions)
    )
    held = F.expr(f"inline(filter(array({slots}), r -> r._rank >= _end - _n AND r._rank < _end))")
    wanted = ranked.select("_metric", "_month", "_bin", "_low", "_high", "_total", F.expr("_end - _n AS _start"), held)

    # Pass 2: the same in parts of those bins.
    width = f"CAST(coalesce(least(floor(try_divide(_x - _low, _high - _low) * {PARTS}), {PARTS - 1}), 0) AS INT)"
    bins = wanted.groupBy("_metric", "_bin").agg(F.first("_low").alias("_low"), F.first("_high").alias("_high"))
    inside = long.join(F.broadcast(bins), ["_metric", "_bin"]).withColumn("_part", F.expr(width)).drop("_low", "_high")
    parts = _valid(inside, ["_metric", "_bin", "_part"], start, until).drop("_low", "_high")
    key = ["_metric", "_month", "_slot"]
    running = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wanted = (
        parts.join(F.broadcast(wanted.drop("_low", "_high")), ["_metric", "_bin", "_month"])
        .withColumn("_end", F.col("_start") + F.sum("_n").over(running))
        .filter("_rank < _end AND _rank >= _end - _n")
        .select(*key, "_bin", "_part", "_rank", "_total", F.expr("_end - _n AS _start"))
    )

    # Pass 3: the values of those parts.
    running = Window.partitionBy(*key).orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (
        inside.join(F.broadcast(wanted), ["_metric", "_bin", "_part"])
        .filter(F.col("_month").between(F.col(start), F.col(until)))
        .groupBy(*key, "_rank", "_start", "_total", "_x")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_end", F.col("_start") + F.sum("_n").over(running))
        .filter("_rank < _end AND _rank >= _end - _n")
    )
    values = F.transform(F.sort_array(F.collect_list(F.struct("_slot", "_x"))), lambda v: v["_x"])
    return found.groupBy(F.col("_metric").alias("metric"), F.col("_month").alias("month")).agg(
        F.first("_total").alias("n"), values.alias("values")
    )


def interpolated(n, values, fractions: Sequence[float], shift=0):
    """The quantiles from what `interval_quantiles` found, each value moved by `shift` first."""
    out = []
    for i, p in enumerate(fractions):
        low, high = F.get(values, F.lit(2 * i)) + shift, F.get(values, F.lit(2 * i + 1)) + shift
        place = (n - 1) * F.lit(float(p))
        out.append(low + (high - low) * (place - F.floor(place)))
    return F.array(*out)
