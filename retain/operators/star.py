"""Star schema for dashboards: date dimension, joined order facts and their slicers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retain.functions.dates import month_label
from retain.functions.joins import join_dimension
from retain.functions.numeric import round_half_even, sum_money


def dim_date(orders: DataFrame) -> DataFrame:
    """One row per calendar day from the first to the last order."""
    span = orders.agg(F.min("order_date").alias("_from"), F.max("order_date").alias("_to"))
    day = F.col("date")
    return (
        span.filter(F.col("_from").isNotNull())
        .select(F.explode(F.sequence("_from", "_to")).alias("date"))
        .select(
            "date",
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month"),
            month_label(day).alias("year_month"),
            F.dayofmonth(day).alias("day"),
        )
    )


def order_payments(payments: DataFrame) -> DataFrame:
    """One row per order over all its payments: how many, how much succeeded, and the method and
    status of the one that counts, the last successful or else the last."""
    success = F.col("payment_status") == "Success"
    counts = F.max(F.struct(success.alias("ok"), "payment_date", "payment_id", "payment_method", "payment_status"))
    paid = sum_money(F.when(success, F.col("amount")).otherwise(F.lit(0.0)))
    return (
        payments.groupBy("order_id")
        .agg(F.count(F.lit(1)).alias("payments"), paid.alias("paid_amount"), counts.alias("_p"))
        .select("order_id", "payments", "paid_amount", "_p.payment_method", "_p.payment_status")
    )


def star_fact(
    lines: DataFrame, customers: DataFrame, products: DataFrame, payments: DataFrame
) -> DataFrame:
    """Order lines with the attributes of their customer, product, payments and date."""
    ids = [c for c in ("order_id", "line_no") if c in lines.columns]
    facts = lines.select(
        *ids, "customer_id", "product_id", "order_date", "quantity", "discount", "total_amount",
        "order_status", "channel",
    )
    paid = order_payments(payments)
    region = F.col("country") if "country" in customers.columns else F.lit(None).cast("string")
    buyer = customers.select("customer_id", "customer_segment", "state", region.alias("region"))
    item = products.select("product_id", "product_name", "category")
    joined = facts
    # The products last: their names are the longest texts, and each join may shuffle what the ones before it added.
    for dimension, key in ((paid, "order_id"), (buyer, "customer_id"), (item, "product_id")):
        joined = join_dimension(joined, dimension, key, spread_by=ids, count_in=facts)
    return (
        joined.withColumns({"year": F.year("order_date"), "year_month": month_label(F.col("order_date"))})
        .select(
            *ids, "order_date", "year", "year_month", "customer_id", "customer_segment", "state", "region",
            "product_id", "product_name", "category", "payment_method", "payment_status",
            F.coalesce("payments", F.lit(0)).alias("payments"), "paid_amount", "quantity", "discount", "total_amount", "order_status", "channel",
        )
    )


def store_star(fact: DataFrame, path: str) -> DataFrame:
    """The star written by month, and read back with the types it had.

    Rows are brought together by month first, large months in several tasks, so a task writes few files.
    """
    fact.hint("rebalance", F.col("year_month")).write.partitionBy("year_month").parquet(path)
    return fact.sparkSession.read.schema(fact.schema).parquet(path).select(*fact.columns)


def slice_star(stored: DataFrame, dates: DataFrame, date_from: dt.date, date_to: dt.date, **slicers) -> DataFrame:
    """`apply_slicers` on a star stored by month, which reads only the months of the date dimension's days.

    The dimension is filtered and joined by month; its months are known when the star is scanned.
    """
    days = dates.filter(F.col("date").between(F.lit(date_from), F.lit(date_to)))
    # One row per calendar month.
    inside = stored.join(F.broadcast(days.select("year_month").distinct()), "year_month", "left_semi")
    return apply_slicers(inside, date_from=date_from, date_to=date_to, **slicers).select(*stored.columns)


def apply_slicers(
    fact: DataFrame,
    *,
    date_from: dt.date | None = None,
    date_to: dt.date | None = None,
    segments: Sequence[str] | None = None,
    categories: Sequence[str] | None = None,
    channels: Sequence[str] | None = None,
    states: Sequence[str] | None = None,
    regions: Sequence[str] | None = None,
) -> DataFrame:
    """Dashboard filters; those that are None let every row pass."""
    tests: list[Column] = []
    if date_from is not None:
        tests.append(F.col("order_date") >= F.lit(date_from))
    if date_to is not None:
        tests.append(F.col("order_date") <= F.lit(date_to))
    for column, allowed in (
        ("customer_segment", segments), ("category", categories), ("channel", channels), ("state", states),
        ("region", regions),
    ):
        if allowed is not None:
            tests.append(F.col(column).isin(*allowed))
    return reduce(DataFrame.filter, tests, fact)


def revenue_by_month_and_channel(fact: DataFrame) -> DataFrame:
    return fact.groupBy("year_month", "channel").agg(
        F.count(F.lit(1)).alias("purchases"),
        round_half_even(sum_money(F.col("total_amount")), 2).alias("revenue"),
    )
