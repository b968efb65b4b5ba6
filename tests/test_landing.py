"""CSV landed in one pass with counts, and cleaned tables written with theirs."""

import datetime as dt

from pyspark.sql import functions as F

from retain.operators import cleaning
from retain.sources.bundle import INGEST_ORDER, Bundle, unreadable
from retain.sources.landing import land_csv, write_counted
from retain.sources.schemas import REQUIRED

HEAD = ",".join(REQUIRED["payments"])


def write(path, lines):
    path.write_text("\n".join([HEAD, *lines]) + "\n")
    return str(path)


def test_counts_of_the_write_are_those_of_a_second_read(spark, tmp_path):
    days = ["2024-01-02", "soon", "N/A", "2024/03/04 "]
    lines = [f"P{i % 9},O{i},C,{days[i % 4].strip()},{'x' if i % 5 == 0 else i},card,Success" for i in range(40)]
    path = write(tmp_path / "payments.csv", lines)
    table, n, counts = land_csv(spark, path, "payments")
    again = {r.column_name: (r.present, r.unreadable) for r in unreadable(spark, path, "payments").collect()}
    assert n == table.count() == 40 and counts == again == {"payment_date": (30, 10), "amount": (40, 8)}
    assert table.filter("payment_id = 'P0'").orderBy(INGEST_ORDER).first().order_id == "O0"
    assert not [c for c in table.columns if c.startswith("_present")]
    # Places are stored, so that the first rows are fetched by them.
    kept = cleaning.keep_first(table, ["payment_id"])
    assert "LeftSemi" in kept._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.order_id for r in kept.collect()) == [f"O{i}" for i in range(9)]


def test_a_file_without_rows(spark, tmp_path):
    table, n, counts = land_csv(spark, write(tmp_path / "payments.csv", []), "payments")
    assert n == 0 and table.collect() == [] and counts == {"payment_date": (0, 0), "amount": (0, 0)}


def test_written_counts_of_an_empty_frame(spark, tmp_path):
    empty = spark.createDataFrame([], "a int")
    assert write_counted(empty, str(tmp_path / "e"), F.count(F.lit(1)).alias("rows")) == {"rows": 0}
    assert write_counted(spark.range(5), str(tmp_path / "f"), F.count(F.lit(1)).alias("rows"), F.max("id").alias("top")) == {"rows": 5, "top": 4}


def test_stored_tables_and_their_summary(spark):
    payments = spark.createDataFrame(
        [(i % 7, i, None if i == 3 else 1.0) for i in range(20)], "payment_id int, order_id int, amount double"
    )
    reviews = spark.createDataFrame([(1, 1, 1, 9, None), (1, 1, 1, 2, None)], "review_id int, order_id int, customer_id int, rating int, review_text string")
    day = dt.date(2024, 1, 1)
    customers = spark.createDataFrame([(1, day, 200, 3, None, None)], "customer_id int, registration_date date, age int, loyalty_points int, gender string, phone string")
    products = spark.createDataFrame([(1, 2.0, 1.0, 3.0, None)], "product_id int, price double, cost double, rating double, stock_qty int")
    orders = spark.createDataFrame([(1, 1, 1, day, 5.0)], "order_id int, customer_id int, product_id int, order_date date, total_amount double")
    raw = Bundle(customers, orders, products, payments, reviews)
    for before in (None, {n: df.count() for n, df in raw.items()}):
        clean = cleaning.clean_all(raw)
        stored, summary = cleaning.store_cleaned(raw, clean, before)
        assert sorted(summary.collect()) == sorted(cleaning.cleaning_summary(raw, clean).collect())
        assert stored.payments.count() == 6 and stored.payments.columns == clean.payments.columns
