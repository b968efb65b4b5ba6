"""What the plans must and must not contain, since results alone cannot show it."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from retain.operators import cleaning, features, profiling, retention, revenue, segmentation, star
from retain.plans import queries
from retain.sources import retail_star
from retain.sources.bundle import INGEST_ORDER, read_parquet
from retain.sources.schemas import REQUIRED

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def orders(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "orders.parquet")
    retail_star.orders(spark, SF_DIR).write.parquet(path)
    return spark.read.parquet(path)


def test_filter_and_columns_reach_the_scan(orders):
    text = plan(revenue.monthly_revenue(orders))
    assert "EqualTo(order_status,Completed)" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"order_date", "total_amount", "order_status"}


def test_hot_customers_are_reduced_before_each_shuffle(orders):
    for df in (features.build_rfm(orders), retention.monthly_retention(orders), cleaning.keep_first(orders, ["order_id"])):
        text = plan(df)
        below_first_shuffle = text[text.rindex("Exchange hashpartitioning"):]
        assert "partial_" in below_first_shuffle


def test_scores_need_no_join_and_no_window_over_all_customers(orders):
    rfm = features.build_rfm(orders)
    text = plan(segmentation.rfm_segmentation(rfm))
    assert "NestedLoopJoin" not in text and "CartesianProduct" not in text
    for match in re.finditer(r"Window \[[^\n]*\n[^\n]*\n[^\n]*", text):
        assert "SinglePartition" not in match.group(0)


def test_unused_fences_are_not_computed(orders):
    cleaned = cleaning.clean_orders(orders)
    assert "percentile_approx" in plan(cleaned)
    assert "percentile_approx" not in plan(retention.monthly_retention(cleaned))


def test_keep_first_decides_on_keys_and_places_alone(spark, tmp_path):
    df = spark.createDataFrame([(i % 40, i, "x" * 50) for i in range(400)], "payment_id int, amount int, order_id string")
    absent = [c for c in REQUIRED["payments"] if c not in df.columns]
    df.select("*", *[F.lit(None).cast("string").alias(c) for c in absent]).repartition(3).write.parquet(str(tmp_path / "p"))
    read = read_parquet(spark, str(tmp_path / "p"), "payments")
    kept = cleaning.keep_first(read, ["payment_id"])
    text = plan(kept)
    deciding = text[text.rindex("HashAggregate" if "HashAggregate" in text else "SortAggregate"):]
    assert "LeftSemi" in text and "order_id" not in deciding and "amount" not in deciding
    slow = read.withColumn(INGEST_ORDER, F.to_json(INGEST_ORDER)).drop(INGEST_ORDER)
    assert kept.count() == slow.select("payment_id").distinct().count() == 40
    first = read.groupBy("payment_id").agg(F.min(INGEST_ORDER).alias("p"))
    assert kept.join(first, "payment_id").filter(F.col(INGEST_ORDER) != F.col("p")).count() == 0


def test_slices_read_only_their_months(spark, tmp_path):
    days = [dt.date(2000, 1, 1) + dt.timedelta(i * 7) for i in range(150)]
    fact = spark.createDataFrame([(d, d.strftime("%Y-%m"), "Web", 1.0) for d in days], "order_date date, year_month string, channel string, total_amount double")
    stored = star.store_star(fact, str(tmp_path / "star"))
    sliced = star.slice_star(stored, star.dim_date(fact), dt.date(2001, 1, 15), dt.date(2001, 3, 10))
    assert "dynamicpruning" in plan(sliced).lower()
    assert sliced.columns == fact.columns and sliced.schema.names == stored.schema.names
    assert sorted(r.order_date for r in sliced.collect()) == [d for d in days if dt.date(2001, 1, 15) <= d <= dt.date(2001, 3, 10)]


def test_a_profile_ships_no_text(spark):
    df = spark.createDataFrame([("a" * 500, 1.5), (None, -0.0)], "t string, x double")
    text = plan(profiling._value_counts(df))
    exchange = text[text.index("Exchange hashpartitioning"):].split("\n")[0]
    assert "place#" in exchange and "t#" not in exchange and "x#" not in exchange
    assert profiling._value_counts(df).dtypes == [("place", "int"), ("absent", "boolean"), ("h1", "bigint"), ("h2", "bigint"), ("n", "bigint")]


def test_passes_over_lines_read_stored_rows(spark):
    for df in (queries.lines(spark, SF_DIR), queries.orders(spark, SF_DIR)):
        text = plan(df.groupBy("order_status").agg(F.sum("total_amount")))
        assert "percentile_approx" in text and "min(struct" not in text and "Join" not in text.replace("BroadcastHashJoin", "")


def test_star_counts_keys_in_stored_lines_and_adds_names_last(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        clean = [f(spark, SF_DIR) for f in (queries.lines, queries.customers, queries.products, queries.payments)]
        text = plan(star.star_fact(*clean))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Only the last join, the topmost in the plan, has the products' names.
    assert "product_name" in text and "product_name" not in text[text.index("Join [customer_id"):].split("product_id")[0]
    assert len(re.findall(r"min\(struct\(customer_id", text)) == 0
