"""Revenue, product and review tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retain.config import DEFAULT, Config
from retain.functions.dates import month_label, month_start
from retain.functions.numeric import MONEY_TYPE, ratio, round_half_even, sum_money
from retain.functions.rows import add_row
from retain.operators.features import completed_orders
from retain.operators.statistics import pearson


def _by_month(orders: DataFrame, config: Config) -> DataFrame:
    return (
        completed_orders(orders, config)
        .filter(F.col("order_date").isNotNull())
        .groupBy(month_start(F.col("order_date")).alias("month"))
        .agg(sum_money(F.col("total_amount")).alias("revenue"))
    )


def monthly_revenue(orders: DataFrame, config: Config = DEFAULT) -> DataFrame:
    return (
        _by_month(orders, config)
        .select(month_label(F.col("month")).alias("month"), round_half_even(F.col("revenue"), 2).alias("revenue"))
        .orderBy("month")
    )


def monthly_summary(orders: DataFrame, last: int | None = None, config: Config = DEFAULT) -> DataFrame:
    """Revenue, orders, distinct customers and order value per month; `last` keeps the latest.

    Customers are counted from one row per customer and month, so a month with very many
    orders never needs a distinct set in one task.
    """
    per_customer = (
        completed_orders(orders, config)
        .filter(F.col("order_date").isNotNull())
        .groupBy(month_start(F.col("order_date")).alias("_month"), "customer_id")
        .agg(
            F.sum(F.col("total_amount").cast(MONEY_TYPE)).alias("_sum"),
            F.count("order_id").alias("_orders"),
        )
    )
    months = per_customer.groupBy("_month").agg(
        F.sum("_sum").cast("double").alias("revenue"),
        F.sum("_orders").alias("orders"),
        F.count("customer_id").alias("customers"),
    )
    table = months.select(
        month_label(F.col("_month")).alias("month"),
        round_half_even(F.col("revenue"), 2).alias("revenue"),
        "orders",
        "customers",
        round_half_even(ratio(F.col("revenue"), F.col("orders")), 2).alias("avg_order_value"),
    )
    if last is None:
        return table.orderBy("month")
    return table.orderBy(F.desc("month")).limit(last)


def mom_growth(orders: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Growth over the calendar month before; null if that month had no revenue."""
    months = _by_month(orders, config)
    before = months.select(
        F.add_months("month", 1).alias("month"), F.col("revenue").alias("prev_revenue")
    )
    change = ratio(F.col("revenue") - F.col("prev_revenue"), F.col("prev_revenue"))
    return (
        months.join(before, "month", "left")
        .select(
            month_label(F.col("month")).alias("month"),
            round_half_even(F.col("revenue"), 2).alias("revenue"),
            round_half_even(F.col("prev_revenue"), 2).alias("prev_revenue"),
            round_half_even(change * 100, 4).alias("growth_pct"),
        )
        .orderBy("month")
    )


def mtd_revenue(orders: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Revenue per day and since the start of its month. Days are summed before the window,
    which therefore holds at most 31 rows."""
    daily = (
        completed_orders(orders, config)
        .filter(F.col("order_date").isNotNull())
        .groupBy("order_date")
        .agg(F.sum(F.col("total_amount").cast(MONEY_TYPE)).alias("_revenue"))
    )
    month = Window.partitionBy(month_start(F.col("order_date"))).orderBy("order_date")
    to_date = F.sum("_revenue").over(month.rowsBetween(Window.unboundedPreceding, 0))
    return daily.select(
        "order_date",
        round_half_even(F.col("_revenue").cast("double"), 2).alias("revenue"),
        round_half_even(to_date.cast("double"), 2).alias("mtd_revenue"),
    )


def revenue_by_channel(orders: DataFrame, config: Config = DEFAULT) -> DataFrame:
    total = sum_money(F.col("total_amount"))
    return (
        completed_orders(orders, config)
        .filter(F.col("channel").isNotNull())
        .groupBy("channel")
        .agg(F.count(F.lit(1)).alias("orders"), round_half_even(total, 2).alias("revenue"))
        .orderBy(F.desc("revenue"), "channel")
    )


def product_sales(lines: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Purchases, revenue and units per product: the small side of every product join."""
    units = "quantity" if "quantity" in lines.columns else None
    return (
        completed_orders(lines, config)
        .filter(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            F.count(F.lit(1)).alias("purchases"),
            F.sum(F.col("total_amount").cast(MONEY_TYPE)).alias("revenue"),
            (F.sum(units) if units else F.lit(None).cast("long")).alias("units"),
        )
    )


def top_products(lines: DataFrame, products: DataFrame, n: int = 15, config: Config = DEFAULT) -> DataFrame:
    """The n products with the highest revenue."""
    return (
        product_sales(lines, config)
        .join(products.select("product_id", "product_name", "category"), "product_id")
        .orderBy(F.desc("revenue"), "product_id")
        .limit(n)
        .select(
            "product_id", "product_name", "category",
            round_half_even(F.col("revenue").cast("double"), 2).alias("revenue"),
        )
    )


def category_sales(lines: DataFrame, products: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Purchases and revenue per known category. Lines are summed per product before the
    join, so a best-selling product is one row there."""
    return (
        product_sales(lines, config)
        .join(products.select("product_id", "category"), "product_id")
        .filter(F.col("category").isNotNull())
        .groupBy("category")
        .agg(
            F.sum("purchases").alias("purchases"),
            round_half_even(F.sum("revenue").cast("double"), 2).alias("revenue"),
        )
    )


def revenue_by_category(lines: DataFrame, products: DataFrame, config: Config = DEFAULT) -> DataFrame:
    return (
        category_sales(lines, products, config)
        .select("category", "revenue")
        .orderBy(F.desc("revenue"), "category")
    )


def rating_by_category(reviews: DataFrame, products: DataFrame) -> DataFrame:
    per_product = reviews.groupBy("product_id").agg(
        F.sum("rating").alias("_stars"), F.count("rating").alias("_rated"), F.count("review_id").alias("reviews")
    )
    return (
        per_product.join(products.select("product_id", "category"), "product_id")
        .filter(F.col("category").isNotNull())
        .groupBy("category")
        .agg(
            F.sum("reviews").alias("reviews"),
            round_half_even(ratio(F.sum("_stars"), F.sum("_rated")), 4).alias("avg_rating"),
        )
        .orderBy("category")
    )


def revenue_discount_corr(lines: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Purchases and revenue per discount, with the overall correlation alongside."""
    done = completed_orders(lines, config)
    total = sum_money(F.col("total_amount"))
    per_discount = (
        done.filter(F.col("discount").isNotNull())
        .groupBy("discount")
        .agg(
            F.count(F.lit(1)).alias("purchases"),
            round_half_even(total, 2).alias("revenue"),
            round_half_even(ratio(total, F.count("total_amount")), 2).alias("avg_revenue"),
        )
    )
    overall = done.agg(round_half_even(pearson("discount", "total_amount"), 4).alias("correlation"))
    return add_row(per_discount, overall).orderBy("discount")


def stock_vs_demand(lines: DataFrame, products: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Units sold against units in stock, for every product."""
    sold = product_sales(lines, config).select("product_id", "units")
    return (
        products.select("product_id", "category", "stock_qty")
        .join(sold, "product_id", "left")
        .select(
            "product_id",
            "category",
            "stock_qty",
            F.coalesce("units", F.lit(0)).alias("units_sold"),
            round_half_even(ratio(F.col("stock_qty"), F.col("units")), 4).alias("stock_per_unit_sold"),
        )
    )
