"""Exact quantiles of any number of groups, of any size, from values dealt out by ranges.

Equal values of a group are counted first. The counts are dealt out by ranges of (group, value) and
written once with the number of their range, so that a large group lies in several ranges and many
small ones share one. Sums per group and range, of which there are at most one per group plus one
per range, say how many rows come before each range; the rest is a running total inside one range.
Nothing is broadcast and no task holds more than a range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retain.session import materialize


class RankedValues:
    """The values of `column` by `group`. Rows with a null group or value take no part."""

    def __init__(self, df: DataFrame, group: str, column: str):
        self.group = group
        values = df.select(F.col(group), F.col(column).cast("double").alias("_x")).dropna()
        counts = values.groupBy(group, "_x").agg(F.count(F.lit(1)).alias("_n"))
        ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = counts.repartitionByRange(ranges, group, "_x").withColumn("_range", F.spark_partition_id())
        self.counts = materialize(dealt, "ranges")

    def parts(self) -> DataFrame:
        """(group, _range, _before, _total): rows of the group in earlier ranges, and in all."""
        parts = self.counts.groupBy(self.group, "_range").agg(F.sum("_n").alias("_rows"))
        whole = Window.partitionBy(self.group)
        earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        return parts.select(
            self.group, "_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_rows").over(whole).alias("_total"),
        )

    def with_parts(self, parts: DataFrame) -> DataFrame:
        """The counted values with a row per group and range beside them."""
        return self.counts.join(parts, [self.group, "_range"])

    def quantiles(self, fractions: Sequence[float]) -> DataFrame:
        """One row per group: linear-interpolated quantiles as an array `q`, and the rows `n`."""
        running = Window.partitionBy(self.group, "_range").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
        ranked = self.with_parts(self.parts()).withColumn("_end", F.col("_before") + F.sum("_n").over(running))
        places = [f"(_total - 1) * {float(p)!r}D" for p in fractions]
        slots = ", ".join(
            f"struct({2 * i} AS _slot, floor({p}) AS _rank), struct({2 * i + 1} AS _slot, ceil({p}) AS _rank)" for i, p in enumerate(places)
        )
        held = F.expr(f"inline(filter(array({slots}), r -> r._rank >= _end - _n AND r._rank < _end))")
        found = ranked.select(self.group, "_total", "_x", held)
        out = []
        for i, p in enumerate(places):
            low, high = (f"max(CASE WHEN _slot = {2 * i + k} THEN _x END)" for k in (0, 1))
            share = p.replace("_total", "max(_total)")
            out.append(f"{low} + ({high} - {low}) * ({share} - floor({share}))")
        return found.groupBy(self.group).agg(F.expr(f"array({', '.join(out)})").alias("q"), F.max("_total").alias("n"))
