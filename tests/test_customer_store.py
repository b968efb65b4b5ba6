"""Tables stored by customer: same results, no shuffle on the customer, months pruned, large customers apart."""

import datetime as dt
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from retain.operators import features, revenue
from retain.session import materialize
from retain.sources.bundle import Bundle
from retain.sources.customer_store import bucket_number, large_customers, store_by_customer

START = dt.date(2023, 1, 1)


def tables(spark):
    """Customer 7 has half of all orders; customer 3 has none, customer 40 only orders."""
    orders = [(i, 7 if i % 2 else i % 37, START + dt.timedelta(i % 200), "Completed" if i % 5 else "Returned", float(i), "Web", i % 4)
              for i in range(600) if i % 37 != 3 or i % 2]
    orders += [(1000, 40, START, "Completed", 5.0, "App", 1)]
    customers = [(i, START, 30) for i in [*range(37), None]]
    return Bundle(
        customers=spark.createDataFrame(customers, "customer_id long, registration_date date, age int"),
        orders=spark.createDataFrame(orders, "order_id long, customer_id long, order_date date, order_status string, total_amount double, channel string, product_id long"),
        products=spark.createDataFrame([(i, f"c{i % 2}") for i in range(4)], "product_id long, category string"),
        payments=spark.createDataFrame([], "payment_id long"),
        reviews=spark.createDataFrame([(i, i % 20, i % 5) for i in range(90)], "review_id long, customer_id long, rating int"),
    )


@pytest.fixture(scope="module")
def stored(spark):
    return store_by_customer(tables(spark), buckets=6)


def build(b):
    return features.build_customer_features(b.customers, b.orders, b.products, b.reviews, b.order_lines)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_large_customers_are_found_and_lie_apart(spark, stored):
    assert [r.customer_id for r in large_customers([tables(spark).orders], 6).collect()] == [7]
    assert {r.customer_id for r in stored.apart.orders.select("customer_id").distinct().collect()} == {7}
    assert stored.usual.orders.filter("customer_id = 7").count() == 0
    # Its rows are spread over tasks, though a bucket by itself would be one.
    files = stored.apart.orders.select(F.col("_metadata.file_path")).distinct().count()
    assert files > 6


def test_stored_tables_hold_every_row(spark, stored):
    plain = tables(spark)
    for name in ("customers", "orders", "reviews"):
        both = getattr(stored.usual, name).unionByName(getattr(stored.apart, name))
        assert both.columns == getattr(plain, name).columns and rows(both) == rows(getattr(plain, name))


def test_features_are_the_same_without_a_shuffle_by_customer(spark, stored):
    assert rows(stored.per_customer(build)) == rows(build(tables(spark)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rfm = features.build_rfm(stored.usual.orders)
        joined = stored.usual.customers.join(rfm, "customer_id", "left").join(features.build_review_features(stored.usual.reviews), "customer_id", "left")
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "Exchange" not in text
        assert "EqualTo(order_status,Completed)" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_period_reads_only_its_months(spark, stored):
    span = dt.date(2023, 2, 10), dt.date(2023, 4, 5)
    part = stored.between("orders", *span)
    text = part._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*stored_month[^\]]*>= 2023-02", text)
    assert part.inputFiles() and rows(part) == rows(tables(spark).orders.filter(F.col("order_date").between(*map(F.lit, span))))
    assert [r.month for r in revenue.monthly_revenue(part).collect()] == ["2023-02", "2023-03", "2023-04"]


def test_empty_tables(spark):
    plain = tables(spark)
    empty = Bundle(*[df.filter(F.lit(False)) for _, df in plain.items()])
    stored = store_by_customer(empty, buckets=3)
    assert stored.per_customer(build).collect() == []
    assert stored.between("orders", START, START).collect() == []


def test_buckets_follow_the_size_and_not_the_shuffle(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        plain = replace(tables(spark), orders=materialize(tables(spark).orders, "plain"))
        stored = store_by_customer(plain, tables=["orders"])
        cores = spark.sparkContext.defaultParallelism
        assert bucket_number([plain.orders]) == cores
        months = plain.orders.select(F.date_format("order_date", "yyyy-MM")).distinct().count()
        assert stored.usual.orders.select(F.col("_metadata.file_path")).distinct().count() <= cores * months
        assert rows(stored.usual.orders.unionByName(stored.apart.orders)) == rows(plain.orders)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
