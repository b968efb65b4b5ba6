"""Month-over-month moves between segments.

A buyer's state changes only in months with a purchase, so a row holds from one such month to the
one before the next. Neither the quintile edges of a month nor the moves need a row per buyer and
month: edges come from `interval_quantiles`, and of the moves a row leaves only the runs of equal
ones, which are added up where they start and taken away behind their end.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retain.config import DEFAULT, Config
from retain.functions.dates import month_index
from retain.functions.intervals import cumulated, interpolated, interval_quantiles
from retain.functions.numeric import money
from retain.functions.rows import with_row
from retain.operators.features import completed_orders
from retain.operators.segmentation import QUINTILES, SCORES, score_from_edges, segment_of

STATE = ("last_day", "frequency", "monetary")


def last_month_end(until: dt.date) -> dt.date:
    """The last month end up to a day."""
    return (until + dt.timedelta(days=1)).replace(day=1) - dt.timedelta(days=1)


def first_day(month: Column) -> Column:
    """The first day of a month numbered year * 12 + month."""
    return F.make_date(
        F.floor((month - 1) / 12).cast("int"), (F.pmod(month - 1, F.lit(12)) + 1).cast("int"), F.lit(1)
    )


def end_day(month: Column) -> Column:
    """The last day of a month, as a number of days."""
    return F.unix_date(F.last_day(first_day(month)))


def customer_states(orders: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Last purchase (as a number of days), frequency and monetary value of every buyer, by interval.

    One row per buyer and month with a purchase: the state at the end of `month` and of all
    months to `until`, the one before the next purchase or the last month end before the
    snapshot day. `before` is the state of the month before. Months are numbered (year * 12 + month).
    """
    last = last_month_end(config.snapshot)
    monthly = (
        completed_orders(orders, config)
        .filter(F.col("customer_id").isNotNull() & (F.col("order_date") <= F.lit(last)))
        .groupBy("customer_id", month_index(F.col("order_date")).alias("month"))
        .agg(
            F.unix_date(F.max("order_date")).alias("last_day"),
            F.count("order_id").alias("_n"),
            F.sum(money(F.col("total_amount"))).alias("_sum"),
        )
    )
    # One row per month with a purchase, so a customer's window is as long as its history.
    months = Window.partitionBy("customer_id").orderBy("month")
    upto = months.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = F.coalesce(F.lead("month").over(months) - 1, F.lit(last.year * 12 + last.month))
    held = monthly.select(
        "customer_id", "month", until.alias("until"), "last_day", F.sum("_n").over(upto).alias("frequency"),
        F.sum("_sum").over(upto).cast("double").alias("monetary"),
    )
    before = F.lag(F.struct(*STATE)).over(months)
    return (
        held.withColumn("before", before).withColumn("before", F.when(F.col("before.frequency") > 0, F.col("before")))
        .filter("frequency > 0")
    )


def month_edges(states: DataFrame) -> DataFrame:
    """One row: for every month in order the quintile edges of all buyers at its end.

    Recency is the month's end less the last purchase, so its ranks are those of the purchase days.
    """
    valued = states.withColumn("recency_days", -F.col("last_day"))
    columns = [column for column, _ in SCORES.values()]
    found = interval_quantiles(valued, columns, "month", "until", QUINTILES)
    shift = F.when(F.col("metric") == "recency_days", end_day(F.col("month"))).otherwise(0)
    edges = found.select("metric", "month", interpolated(F.col("n"), F.col("values"), QUINTILES, shift).alias("e"))
    per_month = edges.groupBy("month").agg(*[F.max(F.when(F.col("metric") == c, F.col("e"))).alias(c) for c in columns])
    return per_month.agg(F.sort_array(F.collect_list(F.struct("month", end_day(F.col("month")).alias("end"), *columns))).alias("months"))


def _segments(state: dict[str, Column], ends: Column) -> Column:
    """The segments of a state at some month ends, `ends` their entries of `month_edges`."""

    def scores(at: Column) -> Column:
        values = {"recency_days": at["end"] - state["last_day"], "frequency": state["frequency"], "monetary": state["monetary"]}
        return F.struct(
            *[score_from_edges(values[column], at[column], descending).alias(name) for name, (column, descending) in SCORES.items()]
        )

    return F.transform(F.transform(ends, scores), lambda s: segment_of(*[s[name] for name in SCORES]))


def moves(states: DataFrame) -> DataFrame:
    """(month, from_segment, to_segment, change): what begins and, as -1, what has ended."""
    rows = with_row(states, "_edges", month_edges(states)).withColumn("_months", F.col("_edges.months")).drop("_edges")
    # Positions count from 1, and the first month is one in which a state begins.
    at = F.col("month") - F.col("_months")[0]["month"] + 1
    now = _segments({c: F.col(c) for c in STATE}, F.slice("_months", at, F.col("until") - F.col("month") + 1))
    then = _segments({c: F.col(f"before.{c}") for c in STATE}, F.slice("_months", F.greatest(at - 1, F.lit(1)), F.lit(1)))
    rows = rows.select(
        F.col("month") - F.col("before").isNotNull().cast("int"),
        F.when(F.col("before").isNotNull(), F.concat(then, now)).otherwise(now),
    ).toDF("_base", "_s").filter(F.size("_s") > 1)
    pairs = F.transform(
        F.slice("_s", F.lit(2), F.size("_s") - 1),
        lambda s, i: F.struct((F.col("_base") + i + 1).alias("month"), F.get("_s", i).alias("a"), s.alias("b")),
    )
    rows = rows.select("_base", F.size("_s").alias("_size"), pairs.alias("_p"))
    new = lambda p, i: (i == 0) | (F.get("_p", i - 1)["a"] != p["a"]) | (F.get("_p", i - 1)["b"] != p["b"])
    rows = rows.select((F.col("_base") + F.col("_size")).alias("_behind"), F.filter("_p", new).alias("_runs"))
    change = lambda month, p, n: F.struct(
        month.alias("month"), p["a"].alias("from_segment"), p["b"].alias("to_segment"), F.lit(n).alias("change")
    )
    changes = F.transform(
        "_runs",
        lambda p, i: F.array(change(p["month"], p, 1), change(F.coalesce(F.get("_runs", i + 1)["month"], F.col("_behind")), p, -1)),
    )
    return rows.select(F.inline(F.flatten(changes)))


def segment_migration(states: DataFrame) -> DataFrame:
    """Customers by segment at one month end and the month end before.

    `states` is read four times: give it a materialized table when it is costly.
    """
    key = ["from_segment", "to_segment"]
    changes = moves(states).groupBy("month", *key).agg(F.sum("change").alias("change"))
    counted = cumulated(changes, key, "month", "change", "customers")
    return counted.select(F.date_format(first_day(F.col("month")), "yyyy-MM").alias("month"), *key, "customers")
