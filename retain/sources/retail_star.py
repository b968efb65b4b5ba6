"""The five tables derived from an order/lineitem star (region … lineitem, events).

Attributes the star lacks are derived from its keys for every row. They include the
defects that cleaning repairs: missing values, out-of-range numbers, bad text, outliers.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retain.functions.joins import join_dimension
from retain.sources.bundle import INGEST_ORDER, Bundle

SNAPSHOT = dt.date(2001, 8, 1)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def _status() -> Column:
    return (
        F.when(F.col("o_orderstatus") == "F", "Completed")
        .when(F.col("o_orderstatus") == "O", "Processing")
        .otherwise("Returned")
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers; the registration date is the date of the first order."""
    first = (
        _table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.min("o_orderdate").cast("date").alias("reg"))
    )
    nation = _table(spark, sf_dir, "nation")
    region = _table(spark, sf_dir, "region")
    joined = (
        _table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(first, "c_custkey", "left")
    )
    key = F.col("c_custkey")
    return joined.select(
        key.alias("customer_id"),
        F.col("c_name").alias("first_name"),
        F.col("n_name").alias("state"),
        F.col("r_name").alias("country"),
        F.when(~_every("c_custkey", 97), F.col("reg")).alias("registration_date"),
        F.when(~_every("c_custkey", 33), (10 + key % 90).cast("int")).alias("age"),
        F.when(_every("c_custkey", 37), None)
        .when(_every("c_custkey", 2), "Female")
        .otherwise("Male")
        .alias("gender"),
        F.when(~_every("c_custkey", 31), key.cast("string")).alias("phone"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.floor("c_acctbal").cast("int").alias("loyalty_points"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return _table(spark, sf_dir, "orders").select(
        key.alias("order_id"),
        F.when(~_every("o_orderkey", 89), F.col("o_custkey")).alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.when(_every("o_orderkey", 101), F.col("o_totalprice") * 20)
        .otherwise(F.col("o_totalprice"))
        .alias("total_amount"),
        _status().alias("order_status"),
        F.when(_every("o_orderkey", 43), "bad")
        .when(F.col("o_orderstatus") == "F", (key % 75).cast("string"))
        .alias("delivery_days"),
        F.col("o_orderpriority").alias("channel"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount"
    )
    heads = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate", "o_orderstatus",
        "o_orderpriority",
    )
    # Lines have no unique id; their position in the scan is the same in every attempt.
    position = F.monotonically_increasing_id()
    return join_dimension(lines, heads, "l_orderkey", spread_by=position, how="inner").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.when(_every("l_orderkey", 61), -1)
        .otherwise(F.col("l_quantity").cast("int"))
        .alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        F.when(_every("l_orderkey", 67), 1.2).otherwise(F.col("l_discount")).alias("discount"),
        F.col("l_extendedprice").alias("total_amount"),
        _status().alias("order_status"),
        F.col("o_orderpriority").alias("channel"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
        F.col("p_retailprice").alias("price"),
        (F.col("p_retailprice") * 0.5).alias("cost"),
        F.when(~_every("p_partkey", 29), F.col("p_size") * 10 - 20).alias("stock_qty"),
        (F.col("p_size") % 7).cast("double").alias("rating"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A payment per order, its outcome by the order's status; some orders have a second one."""
    key = F.col("o_orderkey")
    nth = F.when(_every("o_orderkey", 40), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        _table(spark, sf_dir, "orders")
        .withColumn("nth", F.explode(nth))
        .select(
            (key * 2 + F.col("nth")).alias("payment_id"),
            key.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.date_add(F.col("o_orderdate").cast("date"), F.col("nth")).alias("payment_date"),
            F.when(_every("o_orderkey", 53), None)
            .when(_every("o_orderkey", 59), -F.col("o_totalprice"))
            .otherwise(F.col("o_totalprice"))
            .alias("amount"),
            F.col("o_orderpriority").alias("payment_method"),
            F.when(_every("o_orderkey", 20) & (F.col("nth") == 0), "Failed")
            .when(F.col("o_orderstatus") == "F", "Success")
            .when(F.col("o_orderstatus") == "O", "Pending")
            .otherwise("Refunded")
            .alias("payment_status"),
        )
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log taken as reviews, the kind of event as their text; product keys wrap
    around the part table."""
    parts = _table(spark, sf_dir, "part").agg(F.count(F.lit(1)).alias("_parts"))
    key = F.col("event_id")
    return (
        _table(spark, sf_dir, "events")
        .select(
            key.alias("review_id"),
            key.alias("order_id"),
            F.col("user_id").alias("customer_id"),
            (key % parts.scalar()).alias("product_id"),
            (key % 8).cast("int").alias("rating"),
            F.when(~_every("event_id", 20), F.col("event_type")).alias("review_text"),
            F.col("ts").cast("date").alias("review_date"),
        )
    )


def bundle(spark: SparkSession, sf_dir: str) -> Bundle:
    return Bundle(
        customers=customers(spark, sf_dir),
        orders=orders(spark, sf_dir),
        products=products(spark, sf_dir),
        payments=payments(spark, sf_dir),
        reviews=reviews(spark, sf_dir),
        order_lines=order_lines(spark, sf_dir),
    )


# Per table: its key, and the column that differs between rows with the same key.
_CONFLICTS: dict[str, tuple[str, str, object]] = {
    "customers": ("customer_id", "loyalty_points", -7),
    "orders": ("order_id", "total_amount", 1.0),
    "products": ("product_id", "price", -1.0),
    "payments": ("payment_id", "amount", 1.0),
    "reviews": ("review_id", "rating", 9),
}


def with_duplicates(name: str, df: DataFrame) -> DataFrame:
    """The whole table plus repeated rows: exact copies, and later rows with the same key
    but another value. `ingest_ord` tells which came first."""
    key, column, other = _CONFLICTS[name]
    first = df.withColumn(INGEST_ORDER, F.lit(0))
    copies = first.filter(_every(key, 50))
    conflicts = (
        df.filter(F.col(key) % 70 == 1)
        .withColumn(column, F.lit(other).cast(df.schema[column].dataType))
        .withColumn(INGEST_ORDER, F.lit(1))
    )
    return first.unionByName(copies).unionByName(conflicts)


def bundle_with_duplicates(spark: SparkSession, sf_dir: str) -> Bundle:
    return bundle(spark, sf_dir).map(with_duplicates)
