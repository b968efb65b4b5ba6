"""Customer feature table: recency, frequency, monetary, lifetime value, churn, preferences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retain.config import DEFAULT, Config
from retain.functions.joins import join_dimension
from retain.functions.numeric import ratio, round_half_even, sum_money


def completed_orders(orders: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """The orders that count as purchases."""
    return orders.filter(F.col("order_status") == config.purchase_status)


def build_rfm(orders: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """One row per customer with purchases."""
    per_customer = (
        completed_orders(orders, config)
        .filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.max("order_date").alias("last_order_date"),
            F.min("order_date").alias("first_order_date"),
            F.count("order_id").alias("frequency"),
            sum_money(F.col("total_amount")).alias("monetary"),
        )
    )
    active_days = F.datediff("last_order_date", "first_order_date")
    periods = F.col("customer_lifetime") / F.lit(config.period_days)
    return (
        per_customer.withColumn("recency_days", F.datediff(F.lit(config.snapshot), "last_order_date"))
        .withColumn("customer_lifetime", F.greatest(active_days, F.lit(config.min_lifetime_days)))
        .withColumn(
            "avg_order_value", round_half_even(ratio(F.col("monetary"), F.col("frequency")), 2)
        )
        # Without a lifetime there is no rate; the number of purchases stands in.
        .withColumn(
            "purchase_frequency",
            round_half_even(F.coalesce(ratio(F.col("frequency"), periods), F.col("frequency").cast("double")), 3),
        )
    )


def build_clv(rfm: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Projected value: order value x purchases per period x periods, from the rounded inputs."""
    projected = F.col("avg_order_value") * F.col("purchase_frequency") * config.clv_periods
    return rfm.withColumn("clv", round_half_even(projected, 2))


def build_churn_flag(rfm: DataFrame, config: Config = DEFAULT) -> DataFrame:
    return rfm.withColumn("churned", (F.col("recency_days") > config.churn_days).cast("int"))


def build_review_features(reviews: DataFrame) -> DataFrame:
    return (
        reviews.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            round_half_even(F.avg("rating"), 2).alias("avg_review_rating"),
            F.count("review_id").alias("total_reviews"),
        )
    )


def build_category_features(
    orders: DataFrame,
    products: DataFrame,
    order_lines: DataFrame | None = None,
    config: Config = DEFAULT,
) -> DataFrame:
    """Favourite category and preferred channel: the most frequent value, ties to the lowest.

    A customer whose purchases have no known value gets "Unknown". `mode` keeps one small
    count map per customer and merges it map-side, so a customer with very many purchases
    reaches the final task as one row per task.
    """

    def most_frequent(column: str):
        return F.coalesce(F.mode(column, deterministic=True), F.lit("Unknown"))

    lines = orders if order_lines is None else order_lines
    wanted = [c for c in ("order_id", "line_no", "customer_id", "product_id", "channel") if c in lines.columns]
    bought = (
        completed_orders(lines, config).filter(F.col("customer_id").isNotNull()).select(*wanted)
    )
    with_category = join_dimension(
        bought,
        products.select("product_id", "category"),
        "product_id",
        spread_by=[c for c in ("order_id", "line_no") if c in wanted],
    )
    category = most_frequent("category").alias("favourite_category")
    channel = most_frequent("channel").alias("preferred_channel")
    if order_lines is None:
        return with_category.groupBy("customer_id").agg(category, channel)
    by_category = with_category.groupBy("customer_id").agg(category)
    by_channel = (
        completed_orders(orders, config)
        .filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(channel)
    )
    return by_category.join(by_channel, "customer_id", "outer")


def build_customer_features(
    customers: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    reviews: DataFrame,
    order_lines: DataFrame | None = None,
    config: Config = DEFAULT,
) -> DataFrame:
    """One row per customer. All sides of the joins are unique per customer."""
    rfm = build_churn_flag(build_clv(build_rfm(orders, config), config), config)
    joined = (
        customers.join(rfm, "customer_id", "left")
        .join(build_review_features(reviews), "customer_id", "left")
        .join(build_category_features(orders, products, order_lines, config), "customer_id", "left")
    )
    return fill_absent(joined, config)


def fill_absent(feat: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Values of customers without purchases or reviews: churned, with recency since their
    registration, and zero or "None" elsewhere."""
    since_registration = F.datediff(F.lit(config.snapshot), "registration_date")
    absent = {
        "churned": F.lit(1),
        "frequency": F.lit(0),
        "monetary": F.lit(0.0),
        "recency_days": since_registration,
        "avg_order_value": F.lit(0.0),
        "purchase_frequency": F.lit(0.0),
        "customer_lifetime": F.lit(0),
        "clv": F.lit(0.0),
        "avg_review_rating": F.lit(0.0),
        "total_reviews": F.lit(0),
        "favourite_category": F.lit("None"),
        "preferred_channel": F.lit("None"),
    }
    return feat.withColumns(
        {c: F.coalesce(F.col(c), v) for c, v in absent.items() if c in feat.columns}
    )


def feature_summary(feat: DataFrame) -> DataFrame:
    return feat.agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("churned").alias("churned"),
        round_half_even(F.avg("churned") * 100, 4).alias("churned_pct"),
        round_half_even(ratio(sum_money(F.col("clv")), F.count("clv")), 2).alias("avg_clv"),
        round_half_even(F.avg("recency_days"), 4).alias("avg_recency_days"),
        round_half_even(F.avg("frequency"), 4).alias("avg_frequency"),
        round_half_even(ratio(sum_money(F.col("monetary")), F.count("monetary")), 2).alias("avg_monetary"),
    )


def feature_sample(feat: DataFrame, n: int = 10) -> DataFrame:
    return (
        feat.select(
            "customer_id", "recency_days", "frequency", "monetary", "avg_order_value", "clv", "churned"
        )
        .orderBy("customer_id")
        .limit(n)
    )
