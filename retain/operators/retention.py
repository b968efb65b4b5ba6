"""Monthly and cohort retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retain.config import DEFAULT, Config
from retain.functions.dates import month_index, month_label, month_start
from retain.functions.numeric import ratio, round_half_even
from retain.operators.features import completed_orders

COHORTS = 12
PERIODS = 12


def customer_months(orders: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Purchases per customer and month, with the customer's first month.

    Orders are counted before anything is gathered per customer, so even a customer with a
    third of all orders contributes one row per calendar month to the window.
    """
    per_month = (
        completed_orders(orders, config)
        .filter(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull())
        .groupBy("customer_id", month_start(F.col("order_date")).alias("month"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    first = F.min("month").over(Window.partitionBy("customer_id"))
    return per_month.withColumn("first_month", first)


def _is_repeat() -> Column:
    """The customer has an earlier purchase: in an earlier month or earlier in this one."""
    return (F.col("first_month") < F.col("month")) | (F.col("orders") >= 2)


def monthly_retention(orders: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Share of each month's buyers that had bought before. Rows are unique per customer
    and month, so plain counts are the distinct customers."""
    return (
        customer_months(orders, config)
        .groupBy("month")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.count_if(_is_repeat()).alias("repeat_customers"),
        )
        .select(
            month_label(F.col("month")).alias("month"),
            "customers",
            "repeat_customers",
            round_half_even(ratio(F.col("repeat_customers"), F.col("customers")) * 100, 6).alias(
                "retention_rate"
            ),
        )
        .orderBy("month")
    )


def avg_retention(orders: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Mean of the monthly rates, every month with the same weight."""
    return monthly_retention(orders, config).agg(
        F.count(F.lit(1)).alias("months"),
        round_half_even(F.avg("retention_rate"), 4).alias("avg_retention_rate"),
    )


def retention_rate_rows(orders: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Per month: purchases made by returning customers, divided by distinct customers."""
    starts = F.col("first_month") == F.col("month")
    return (
        customer_months(orders, config)
        .groupBy("month")
        .agg(
            F.sum(F.col("orders") - starts.cast("long")).alias("repeat_orders"),
            F.count(F.lit(1)).alias("customers"),
        )
        .select(
            month_label(F.col("month")).alias("month"),
            "repeat_orders",
            "customers",
            round_half_even(ratio(F.col("repeat_orders"), F.col("customers")), 6).alias("rate"),
        )
    )


def order_lag(orders: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Each purchase with the date of the customer's previous purchase.

    Within a day only the first order looks back to another day. So the look-back runs on
    one row per customer and day, and its result returns to the orders by their unique id:
    a customer with very many orders is never sorted as one group.
    """
    bought = (
        completed_orders(orders, config)
        .filter(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull())
        .select("order_id", "customer_id", "order_date")
    )
    days = bought.groupBy("customer_id", "order_date").agg(F.min("order_id").alias("order_id"))
    previous = F.lag("order_date").over(Window.partitionBy("customer_id").orderBy("order_date"))
    openers = days.select("order_id", previous.alias("_previous"), F.lit(True).alias("_opens"))
    return bought.join(openers, "order_id", "left").select(
        "order_id",
        "customer_id",
        "order_date",
        F.when(F.col("_opens"), F.col("_previous")).otherwise(F.col("order_date")).alias(
            "prev_order_date"
        ),
    )


def cohort_retention(
    orders: DataFrame, customers: DataFrame, config: Config = DEFAULT
) -> DataFrame:
    """Distinct buyers by registration month and months since, relative to period 0.

    The base is the buyers of the registration month, not the cohort's headcount: a rate
    can pass 100, and is null where nobody bought in that month.
    """
    cohorts = customers.select("customer_id", month_start(F.col("registration_date")).alias("cohort_month"))
    active = (
        completed_orders(orders, config)
        .select("customer_id", month_start(F.col("order_date")).alias("order_month"))
        .distinct()
    )
    sizes = (
        active.join(cohorts, "customer_id")
        .withColumn(
            "period_number", month_index(F.col("order_month")) - month_index(F.col("cohort_month"))
        )
        .filter("period_number >= 0")
        .groupBy("cohort_month", "period_number")
        .agg(F.count(F.lit(1)).alias("customers"))
    )
    # One row per period in each cohort.
    base = F.max(F.when(F.col("period_number") == 0, F.col("customers"))).over(
        Window.partitionBy("cohort_month")
    )
    rate = round_half_even(ratio(F.col("customers"), F.col("cohort_size")) * 100, 1)
    return (
        sizes.withColumn("cohort_size", base)
        .withColumn("retention", rate)
        .withColumn("cohort_month", month_label(F.col("cohort_month")))
    )


def cohort_matrix(
    orders: DataFrame,
    customers: DataFrame,
    cohorts: int = COHORTS,
    periods: int = PERIODS,
    config: Config = DEFAULT,
) -> DataFrame:
    """The latest cohorts as rows and the first periods as columns."""
    known = cohort_retention(orders, customers, config).filter(F.col("retention").isNotNull())
    return (
        known.groupBy("cohort_month")
        .pivot("period_number", list(range(periods)))
        .agg(F.avg("retention"))
        .orderBy(F.desc("cohort_month"))
        .limit(cohorts)
        .select("cohort_month", *[F.col(str(p)).alias(f"period_{p}") for p in range(periods)])
    )
