"""Every operator as a query over the order/lineitem star in `sf_dir`."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retain.config import CATEGORICAL_FEATURES, Config
from retain.functions.numeric import MONEY_TYPE, round_half_even
from retain.operators import churn, cleaning, evaluation, features, kmeans, kpis, migration
from retain.operators import profiling, retention, revenue, segmentation, star, statistics
from retain.session import materialize, shared_path
from retain.sources import customer_store, inference, landing, retail_star
from retain.sources.bundle import (
    INGEST_ORDER, Bundle, load_all, nullify_tokens, parse_date, write_table,
)
from retain.sources.schemas import SCHEMAS

Query = Callable[[SparkSession, str], DataFrame]

CONFIG = Config(snapshot=retail_star.SNAPSHOT)
LINE_KEY = ("order_id", "line_no")

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name. Dates leave as ISO text, decimals as double."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(fn(spark, sf_dir))

    QUERIES[fn.__name__] = run
    return fn


def plain(df: DataFrame) -> DataFrame:
    changes = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.DateType):
            changes[field.name] = F.date_format(field.name, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.DecimalType):
            changes[field.name] = F.col(field.name).cast("double")
    return df.withColumns(changes) if changes else df


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.withColumns(
        {
            f.name: round_half_even(F.col(f.name), digits)
            for f in df.schema.fields
            if isinstance(f.dataType, T.DoubleType)
        }
    )


def six_places(df: DataFrame) -> DataFrame:
    """Amounts to six places: engines differ in the last bit of an interpolated fence."""
    return df.withColumn("total_amount", round_half_even(F.col("total_amount"), 6))


# Inputs ---------------------------------------------------------------------------------


# Staged: one row per key is written once, and the passes for fences and medians read one column of it.


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_orders(retail_star.orders(spark, sf_dir), config=CONFIG, staged=True)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_orders(retail_star.order_lines(spark, sf_dir), LINE_KEY, CONFIG, staged=True)


def customers(spark: SparkSession, sf_dir: str, staged: bool = False) -> DataFrame:
    return cleaning.clean_customers(retail_star.customers(spark, sf_dir), staged)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_products(retail_star.products(spark, sf_dir))


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_payments(retail_star.payments(spark, sf_dir))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_reviews(retail_star.reviews(spark, sf_dir))


def raw_bundle(spark: SparkSession, sf_dir: str) -> Bundle:
    return retail_star.bundle_with_duplicates(spark, sf_dir)


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.build_customer_features(
        customers(spark, sf_dir, staged=True),
        orders(spark, sf_dir),
        products(spark, sf_dir),
        reviews(spark, sf_dir),
        lines(spark, sf_dir),
        CONFIG,
    )


def values(spark: SparkSession, sf_dir: str, clean: DataFrame | None = None) -> DataFrame:
    """Customers with recency, frequency, monetary value, lifetime value and churn flag.

    Categories and reviews play no part in segments, so the table is built without them.
    `clean` are cleaned orders that the caller needs too.
    """
    rfm = features.build_rfm(orders(spark, sf_dir) if clean is None else clean, CONFIG)
    valued = features.build_churn_flag(features.build_clv(rfm, CONFIG), CONFIG)
    base = customers(spark, sf_dir).select("customer_id", "registration_date")
    return features.fill_absent(base.join(valued, "customer_id", "left"), CONFIG)


def value_table(spark: SparkSession, sf_dir: str, clean: DataFrame | None = None) -> DataFrame:
    """`values`, written once for readers that pass over it more than once (edges, scaling)."""
    return materialize(values(spark, sf_dir, clean), "value")


def numeric_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numeric features alone: no order lines, products or categories."""
    rfm = features.build_rfm(orders(spark, sf_dir), CONFIG)
    valued = features.build_churn_flag(features.build_clv(rfm, CONFIG), CONFIG)
    stars = features.build_review_features(reviews(spark, sf_dir))
    joined = customers(spark, sf_dir).join(valued, "customer_id", "left").join(stars, "customer_id", "left")
    return features.fill_absent(joined, CONFIG)


def full_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(feature_table(spark, sf_dir), "features")


def segmented(spark: SparkSession, sf_dir: str, clean: DataFrame | None = None) -> DataFrame:
    return segmentation.rfm_segmentation(value_table(spark, sf_dir, clean))


def stand_in_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores computed from the keys of all customers, so that metrics can be checked in SQL."""
    score = ((F.col("customer_id") * 7919 + F.col("recency_days") * 104729) % 1000) / 1000.0
    return (
        value_table(spark, sf_dir)
        .select("customer_id", F.col("churned").alias("label"), score.alias("score"))
        .withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    )


# Sources and sinks ----------------------------------------------------------------------


@query
def scan_counts(spark, sf_dir):
    """The five tables written as CSV, scanned back with types and counted."""
    bundle = load_all(spark, star_as_csv(spark, sf_dir, retail_star.bundle(spark, sf_dir)))
    dates = {"customers": "registration_date", "orders": "order_date", "payments": "payment_date", "reviews": "review_date"}
    amounts = {"customers": "age", "orders": "total_amount", "products": "price", "payments": "amount", "reviews": "rating"}
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(
                F.count(F.lit(1)).alias("rows"),
                (F.count(dates[name]) if name in dates else F.lit(0).cast("long")).alias("dated"),
                F.sum(F.col(amounts[name]).cast(MONEY_TYPE)).cast("double").alias("total"),
            ).select(F.lit(name).alias("table_name"), "*")
            for name, df in bundle.items()
        ],
    )


@query
def null_tokens(spark, sf_dir):
    key = F.col("c_custkey") % 7
    text = (
        F.when(key == 0, "N/A").when(key == 1, "").when(key == 2, "None").when(key == 3, "nan")
        .otherwise(F.col("c_mktsegment"))
    )
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").alias("customer_id"), nullify_tokens(text).alias("customer_segment")
    )


@query
def parse_dates(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    key = F.col("o_orderkey") % 41
    text = (
        F.when(key == 0, "not a date").when(key == 1, F.date_format(day, "dd/MM/yyyy"))
        .when(key == 2, "2001-02-30").when(key == 3, F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .when(key == 4, F.date_format(day, "yyyy/MM/dd")).otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias("order_id"), parse_date(text).alias("order_date")
    )


@query
def inferred_types(spark, sf_dir):
    """Columns that no schema knows, written as CSV: the votes on their types."""
    key = F.col("c_custkey")
    text = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        key.alias("whole"), F.when(key % 3 > 0, key).alias("gaps"), F.col("c_acctbal").alias("amount"),
        F.when(key % 2 == 0, key.cast("string")).otherwise(F.col("c_acctbal").cast("string")).alias("either"),
        F.date_format(F.date_add(F.lit(dt.date(2001, 1, 1)), (key % 365).cast("int")), "yyyy-MM-dd").alias("day"),
        F.when(key % 7 == 0, "2001-02-30").otherwise("2001-02-03").alias("not_day"),
        (key % 2 == 0).cast("string").alias("flag"), F.when(key % 5 == 0, "12d").otherwise("12").alias("mixed"),
        F.when(key % 2 == 0, "N/A").otherwise("None").alias("nothing"), F.lit("99999999999999999999").alias("beyond"),
    )
    path = write_table(text, shared_path(spark, "untyped"), "csv")
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    return inference.type_votes(raw, raw.columns)


@query
def amount_box_by_customer(spark, sf_dir):
    """Five-number summaries of order amounts by customer: as many groups as customers."""
    return rounded(statistics.box_plot(orders(spark, sf_dir), "customer_id", "total_amount"))


def star_as_csv(spark: SparkSession, sf_dir: str, bundle: Bundle) -> str:
    """The five tables as CSV; columns of the schemas that the star lacks are empty."""
    folder = shared_path(spark, "csv")
    for name, df in bundle.items():
        absent = [F.lit(None).cast(t).alias(c) for c, t in SCHEMAS[name].items() if c not in df.columns]
        write_table(df.select("*", *absent), f"{folder}/{name}.csv", "csv")
    return folder


@query
def landed_summary(spark, sf_dir):
    """CSV landed as Parquet, cleaned and stored; rows before and after as the writes counted them."""
    raw = raw_bundle(spark, sf_dir)
    # Orders need a product to stay; the star has theirs in the lines.
    raw = replace(raw, orders=raw.orders.withColumn("product_id", F.lit("several")))
    landed = landing.land_all(spark, star_as_csv(spark, sf_dir, raw))
    return cleaning.store_cleaned(landed.bundle, cleaning.clean_all(landed.bundle), landed.rows)[1]


@query
def landed_columns(spark, sf_dir):
    """Values present and unreadable per typed column, in orders with damaged dates and amounts."""
    key = F.col("order_id")
    day = F.when(key % 41 == 0, "not a date").when(key % 43 == 0, "2001-02-30").when(key % 47 == 0, "N/A")
    amount = F.when(key % 31 == 0, "12,5").otherwise(F.col("total_amount").cast("string"))
    damaged = retail_star.orders(spark, sf_dir).withColumns(
        {"order_date": day.otherwise(F.date_format("order_date", "yyyy-MM-dd")), "total_amount": amount}
    )
    folder = star_as_csv(spark, sf_dir, replace(retail_star.bundle(spark, sf_dir), orders=damaged))
    counts = landing.land_all(spark, folder).columns
    return counts.filter((F.col("present") > 0) & (F.col("table_name") == "orders"))


@query
def table_summary(spark, sf_dir):
    return profiling.table_summary(raw_bundle(spark, sf_dir))


@query
def feature_export(spark, sf_dir):
    """The feature table written for BI tools as CSV and read back with its types."""
    table = feature_table(spark, sf_dir)
    path = write_table(table, shared_path(spark, "export"), "csv")
    return spark.read.option("header", True).option("escape", '"').schema(table.schema).csv(path)


@query
def feature_sample(spark, sf_dir):
    return features.feature_sample(values(spark, sf_dir))


# Profile --------------------------------------------------------------------------------


@query
def dq_nulls(spark, sf_dir):
    return profiling.null_counts(raw_bundle(spark, sf_dir))


@query
def dq_distinct(spark, sf_dir):
    return profiling.distinct_counts(raw_bundle(spark, sf_dir))


@query
def dq_distinct_sketch(spark, sf_dir):
    """The estimates from sketches, held against the exact counts and the stated error."""
    bundle = raw_bundle(spark, sf_dir)
    both = profiling.distinct_counts(bundle).join(profiling.distinct_estimates(bundle), ["table_name", "column_name"])
    off = F.abs(F.col("estimate") - F.col("unique_vals"))
    within = off <= F.col("unique_vals") * 4 * profiling.sketch_error() + 1
    return both.select("table_name", "column_name", "unique_vals", within.alias("within_error"))


@query
def dq_dup_rows(spark, sf_dir):
    return profiling.duplicate_rows(raw_bundle(spark, sf_dir))


@query
def dq_dup_by_column(spark, sf_dir):
    return profiling.duplicates_by_column(raw_bundle(spark, sf_dir))


@query
def dq_report(spark, sf_dir):
    return profiling.data_quality_report(raw_bundle(spark, sf_dir))


@query
def dq_warnings(spark, sf_dir):
    return profiling.quality_warnings(raw_bundle(spark, sf_dir))


# Cleaning -------------------------------------------------------------------------------


@query
def cleaning_summary(spark, sf_dir):
    raw = raw_bundle(spark, sf_dir)
    return cleaning.cleaning_summary(raw, cleaning.clean_all(raw))


@query
def dedupe_rows(spark, sf_dir):
    return cleaning.drop_exact_duplicates(raw_bundle(spark, sf_dir).payments.drop(INGEST_ORDER))


@query
def dedupe_keep_first(spark, sf_dir):
    """Lines repeat their key by nature, without a recorded source order."""
    return cleaning.keep_first(retail_star.order_lines(spark, sf_dir), LINE_KEY)


@query
def drop_null_keys(spark, sf_dir):
    rows = cleaning.drop_null_rows(retail_star.orders(spark, sf_dir), ["order_id", "customer_id", "order_date"])
    return rows.select("order_id", "customer_id", "order_date")


@query
def fill_constants(spark, sf_dir):
    return cleaning.fill_constants(
        retail_star.customers(spark, sf_dir), {"gender": "Unknown", "phone": "N/A"}
    ).select("customer_id", "gender", "phone")


@query
def impute_median(spark, sf_dir):
    return cleaning.impute_median(
        retail_star.customers(spark, sf_dir).select("customer_id", "age"), ["age"]
    )


@query
def clip_ranges(spark, sf_dir):
    return cleaning.clip_columns(
        retail_star.reviews(spark, sf_dir).select("review_id", "rating"), {"rating": (1, 5)}
    )


@query
def clip_lower(spark, sf_dir):
    return cleaning.clip_columns(
        retail_star.order_lines(spark, sf_dir).select(*LINE_KEY, "quantity", "unit_price"),
        {"quantity": (1, None), "unit_price": (0.01, None)},
    )


@query
def coerce_numeric(spark, sf_dir):
    return cleaning.coerce_numeric(
        retail_star.orders(spark, sf_dir).select("order_id", "delivery_days"), "delivery_days"
    )


@query
def iqr_cap(spark, sf_dir):
    return six_places(
        cleaning.cap_outliers(retail_star.orders(spark, sf_dir).select("order_id", "total_amount"), "total_amount")
    )


@query
def iqr_fences(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return rounded(cleaning.iqr_fences(events, "value"), 4)


@query
def clean_customers(spark, sf_dir):
    return cleaning.clean_customers(raw_bundle(spark, sf_dir).customers)


@query
def clean_orders(spark, sf_dir):
    return six_places(cleaning.clean_orders(raw_bundle(spark, sf_dir).orders))


@query
def clean_order_lines(spark, sf_dir):
    return six_places(lines(spark, sf_dir))


@query
def clean_products(spark, sf_dir):
    return cleaning.clean_products(raw_bundle(spark, sf_dir).products)


@query
def clean_payments(spark, sf_dir):
    return cleaning.clean_payments(raw_bundle(spark, sf_dir).payments)


@query
def clean_reviews(spark, sf_dir):
    return cleaning.clean_reviews(raw_bundle(spark, sf_dir).reviews)


# Features -------------------------------------------------------------------------------


@query
def completed_orders(spark, sf_dir):
    return features.completed_orders(retail_star.orders(spark, sf_dir))


@query
def rfm(spark, sf_dir):
    return features.build_rfm(orders(spark, sf_dir), CONFIG)


@query
def clv(spark, sf_dir):
    table = features.build_clv(features.build_rfm(orders(spark, sf_dir), CONFIG), CONFIG)
    return table.select("customer_id", "avg_order_value", "purchase_frequency", "clv")


@query
def churn_flag(spark, sf_dir):
    table = features.build_churn_flag(features.build_rfm(orders(spark, sf_dir), CONFIG), CONFIG)
    return table.select("customer_id", "recency_days", "churned")


@query
def review_features(spark, sf_dir):
    return features.build_review_features(reviews(spark, sf_dir))


@query
def category_channel_features(spark, sf_dir):
    return features.build_category_features(
        orders(spark, sf_dir), products(spark, sf_dir), lines(spark, sf_dir), CONFIG
    )


@query
def customer_features(spark, sf_dir):
    return feature_table(spark, sf_dir)


def stored_by_customer(
    spark: SparkSession, sf_dir: str, tables: Sequence[str] = tuple(customer_store.DATED)
) -> customer_store.CustomerStore:
    clean = Bundle(
        customers=customers(spark, sf_dir, staged=True), orders=orders(spark, sf_dir),
        products=products(spark, sf_dir), payments=payments(spark, sf_dir), reviews=reviews(spark, sf_dir),
        order_lines=lines(spark, sf_dir) if "order_lines" in tables else None,
    )
    return customer_store.store_by_customer(clean, tables=tables)


@query
def stored_features(spark, sf_dir):
    """The feature table from cleaned tables stored by customer: joins without a shuffle."""
    return stored_by_customer(spark, sf_dir).per_customer(
        lambda b: features.build_customer_features(b.customers, b.orders, b.products, b.reviews, b.order_lines, CONFIG)
    )


@query
def stored_period_revenue(spark, sf_dir):
    """Monthly revenue of a period that cuts months, from cleaned orders stored by month."""
    period = stored_by_customer(spark, sf_dir, ["orders"]).between("orders", dt.date(1996, 1, 15), dt.date(1997, 3, 10))
    return revenue.monthly_revenue(period, CONFIG)


@query
def feature_summary(spark, sf_dir):
    return features.feature_summary(values(spark, sf_dir))


# Segments -------------------------------------------------------------------------------


@query
def rfm_scores(spark, sf_dir):
    return segmentation.rfm_scores(value_table(spark, sf_dir)).select(
        "customer_id", "R_score", "F_score", "M_score", "RFM_score"
    )


@query
def rfm_segments(spark, sf_dir):
    return segmented(spark, sf_dir).select("customer_id", "RFM_score", "rfm_segment")


@query
def segment_counts(spark, sf_dir):
    return segmentation.value_counts(segmented(spark, sf_dir), "rfm_segment")


@query
def churn_counts(spark, sf_dir):
    status = F.when(F.col("churned") == 1, "Churned").otherwise("Active")
    return segmentation.value_counts(value_table(spark, sf_dir).select(status.alias("status")), "status")


@query
def customer_segment_counts(spark, sf_dir):
    return segmentation.value_counts(customers(spark, sf_dir), "customer_segment")


@query
def clv_by_segment(spark, sf_dir):
    return segmentation.clv_by_segment(segmented(spark, sf_dir))


@query
def clv_by_segment_active(spark, sf_dir):
    return segmentation.clv_by_segment(segmented(spark, sf_dir), active_only=True)


@query
def segment_summary(spark, sf_dir):
    return segmentation.segment_summary(segmented(spark, sf_dir))


@query
def churn_by_segment(spark, sf_dir):
    return segmentation.churn_by_segment(segmented(spark, sf_dir))


@query
def rfm_scatter(spark, sf_dir):
    """The sample in an order that SQL can state too."""
    order = (F.col("customer_id") * 7919) % 10007
    return segmentation.rfm_scatter(segmented(spark, sf_dir), order=order)


@query
def kmeans_inputs(spark, sf_dir):
    return rounded(kmeans.kmeans_inputs(value_table(spark, sf_dir)))


@query
def kmeans_scaled(spark, sf_dir):
    inputs = kmeans.kmeans_inputs(value_table(spark, sf_dir))
    return rounded(kmeans.kmeans_scaled(inputs), 4)


@query
def kmeans_profile(spark, sf_dir):
    clustered, _, _ = kmeans.kmeans_segmentation(value_table(spark, sf_dir), CONFIG)
    return kmeans.cluster_names(kmeans.kmeans_profile(clustered.drop("kmeans_segment")))


@query
def kmeans_segments(spark, sf_dir):
    clustered, _, _ = kmeans.kmeans_segmentation(value_table(spark, sf_dir), CONFIG)
    return clustered.select("customer_id", "kmeans_cluster", "kmeans_segment")


@query
def kmeans_given_centres(spark, sf_dir):
    """Assignment to fixed centres, medians and names: the part of k-means that is not a fit."""
    table = value_table(spark, sf_dir)
    scaled = rounded(kmeans.kmeans_scaled(kmeans.kmeans_inputs(table)), 4)
    clusters = kmeans.nearest_centre(scaled, [(-1.0, -1.0, -1.0), (0.0, 0.0, 0.0), (1.0, 1.0, 1.0), (1.0, -1.0, 0.0)])
    placed = table.join(clusters.select("customer_id", "kmeans_cluster"), "customer_id")
    return kmeans.cluster_names(kmeans.kmeans_profile(placed))


@query
def kmeans_counts(spark, sf_dir):
    clustered, _, _ = kmeans.kmeans_segmentation(value_table(spark, sf_dir), CONFIG)
    return segmentation.value_counts(clustered, "kmeans_segment")


# Revenue and retention ------------------------------------------------------------------


@query
def monthly_revenue(spark, sf_dir):
    return revenue.monthly_revenue(orders(spark, sf_dir))


@query
def monthly_summary(spark, sf_dir):
    return revenue.monthly_summary(orders(spark, sf_dir))


@query
def monthly_summary_tail(spark, sf_dir):
    return revenue.monthly_summary(orders(spark, sf_dir), last=6)


@query
def mom_growth(spark, sf_dir):
    return revenue.mom_growth(orders(spark, sf_dir))


@query
def mtd_revenue(spark, sf_dir):
    return revenue.mtd_revenue(orders(spark, sf_dir))


@query
def order_lag(spark, sf_dir):
    return retention.order_lag(orders(spark, sf_dir))


@query
def monthly_retention(spark, sf_dir):
    return retention.monthly_retention(orders(spark, sf_dir))


@query
def avg_retention(spark, sf_dir):
    return retention.avg_retention(orders(spark, sf_dir))


@query
def retention_rate_rows(spark, sf_dir):
    return retention.retention_rate_rows(orders(spark, sf_dir))


@query
def cohort_retention(spark, sf_dir):
    return retention.cohort_retention(orders(spark, sf_dir), customers(spark, sf_dir))


@query
def cohort_matrix(spark, sf_dir):
    return retention.cohort_matrix(orders(spark, sf_dir), customers(spark, sf_dir))


@query
def top_products(spark, sf_dir):
    return revenue.top_products(lines(spark, sf_dir), products(spark, sf_dir))


@query
def top_products_10(spark, sf_dir):
    return revenue.top_products(lines(spark, sf_dir), products(spark, sf_dir), n=10)


@query
def revenue_by_category(spark, sf_dir):
    return revenue.revenue_by_category(lines(spark, sf_dir), products(spark, sf_dir))


@query
def revenue_by_channel(spark, sf_dir):
    return revenue.revenue_by_channel(orders(spark, sf_dir))


# KPIs, star schema and dashboard tables -------------------------------------------------


@query
def kpi_cards(spark, sf_dir):
    clean = orders(spark, sf_dir)
    return kpis.kpis(segmented(spark, sf_dir, clean), clean, reviews(spark, sf_dir))


QUERIES["kpis"] = QUERIES.pop("kpi_cards")


@query
def kpi_targets(spark, sf_dir):
    clean = orders(spark, sf_dir)
    return kpis.kpi_targets(segmented(spark, sf_dir, clean), clean, reviews(spark, sf_dir))


@query
def insights(spark, sf_dir):
    clean = orders(spark, sf_dir)
    return kpis.insights(
        segmented(spark, sf_dir, clean), clean, products(spark, sf_dir),
        lines(spark, sf_dir),
    )


@query
def insight_sentences(spark, sf_dir):
    return kpis.insight_sentences(insights(spark, sf_dir))


@query
def customer_funnel(spark, sf_dir):
    return kpis.customer_funnel(values(spark, sf_dir))


@query
def rating_by_category(spark, sf_dir):
    return revenue.rating_by_category(reviews(spark, sf_dir), products(spark, sf_dir))


@query
def revenue_discount_corr(spark, sf_dir):
    return revenue.revenue_discount_corr(lines(spark, sf_dir))


@query
def stock_vs_demand(spark, sf_dir):
    return revenue.stock_vs_demand(lines(spark, sf_dir), products(spark, sf_dir))


@query
def clv_vs_frequency(spark, sf_dir):
    return kpis.clv_vs_frequency(values(spark, sf_dir))


@query
def clv_projection(spark, sf_dir):
    return kpis.clv_projection(segmented(spark, sf_dir))


@query
def top_customers_clv(spark, sf_dir):
    return kpis.top_customers_clv(segmented(spark, sf_dir))


@query
def dim_date(spark, sf_dir):
    return star.dim_date(retail_star.orders(spark, sf_dir))


@query
def star_fact(spark, sf_dir):
    return six_places(
        star.star_fact(lines(spark, sf_dir), customers(spark, sf_dir), products(spark, sf_dir), payments(spark, sf_dir))
    )


@query
def sliced_revenue(spark, sf_dir):
    fact = star.star_fact(lines(spark, sf_dir), customers(spark, sf_dir), products(spark, sf_dir), payments(spark, sf_dir))
    sliced = star.slice_star(
        star.store_star(fact, shared_path(spark, "star")),
        star.dim_date(retail_star.orders(spark, sf_dir)),
        dt.date(1999, 1, 1),
        dt.date(2000, 12, 31),
        segments=["BUILDING", "MACHINERY"],
        categories=["ECONOMY", "STANDARD", "PROMO"],
        channels=["1-URGENT", "2-HIGH"],
        states=[f"NATION_{i}" for i in range(20)],
        regions=["AMERICA", "ASIA", "EUROPE"],
    )
    return star.revenue_by_month_and_channel(sliced)


@query
def segment_migration(spark, sf_dir):
    states = migration.customer_states(orders(spark, sf_dir), config=CONFIG)
    return migration.segment_migration(materialize(states, "states"))


# Statistics -----------------------------------------------------------------------------


@query
def describe_customers(spark, sf_dir):
    return statistics.describe(customers(spark, sf_dir), ["age", "loyalty_points"])


@query
def age_histogram(spark, sf_dir):
    return statistics.histogram(customers(spark, sf_dir), "age", 20)


@query
def clv_histogram(spark, sf_dir):
    return statistics.histogram(value_table(spark, sf_dir).filter("clv > 0"), "clv", 40, cap_at=0.95)


@query
def clv_box_by_churn(spark, sf_dir):
    return statistics.box_plot(value_table(spark, sf_dir).filter("clv > 0"), "churned", "clv")


@query
def corr_with_churn(spark, sf_dir):
    return statistics.correlation_analysis(numeric_table(spark, sf_dir))


@query
def corr_matrix(spark, sf_dir):
    return statistics.correlation_matrix(numeric_table(spark, sf_dir))


@query
def welch_t(spark, sf_dir):
    return statistics.welch(values(spark, sf_dir))


# Churn model ----------------------------------------------------------------------------


@query
def label_encode(spark, sf_dir):
    table = full_table(spark, sf_dir).select("customer_id", *CATEGORICAL_FEATURES)
    return churn.label_encode(table)


@query
def model_inputs(spark, sf_dir):
    return churn.prepare_features(full_table(spark, sf_dir))[0]


@query
def class_weights(spark, sf_dir):
    return churn.class_weights(value_table(spark, sf_dir))


@query
def stratified_split(spark, sf_dir):
    table = value_table(spark, sf_dir).select("customer_id", "churned")
    # A draw that SQL can state too.
    return churn.stratified_split(table, config=CONFIG, draw=(F.col("customer_id") * 7919) % 10007)


@query
def churn_predictions(spark, sf_dir):
    return churn.train_churn_model(full_table(spark, sf_dir), CONFIG).predictions


@query
def feature_importance(spark, sf_dir):
    return churn.feature_importance(churn.train_churn_model(full_table(spark, sf_dir), CONFIG))


@query
def classification_metrics(spark, sf_dir):
    return evaluation.classification_metrics(stand_in_predictions(spark, sf_dir))


@query
def roc_auc(spark, sf_dir):
    return evaluation.roc_auc(stand_in_predictions(spark, sf_dir))


@query
def confusion_matrix(spark, sf_dir):
    return evaluation.confusion_matrix(stand_in_predictions(spark, sf_dir))


@query
def model_metrics(spark, sf_dir):
    """The five metrics of the trained model on its test rows."""
    fitted = churn.train_churn_model(full_table(spark, sf_dir), CONFIG)
    return evaluation.evaluate_model(materialize(fitted.predictions, "predictions"))[0]
