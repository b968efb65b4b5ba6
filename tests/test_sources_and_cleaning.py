import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from retain.operators import cleaning, profiling
from retain.sources.bundle import INGEST_ORDER, load_all, read_csv, read_parquet, unreadable, write_table
from retain.sources.inference import type_votes
from retain.sources.schemas import REQUIRED

CUSTOMERS = """customer_id,registration_date,age,gender,city,state,customer_segment,loyalty_points,phone
C1,2023-01-05,34.0,Female,"Rome, north",N/A,B2C,10,555
C2,bad,,None,Oslo,NO,B2B,-4,
C1,2023-02-01,50,Male,Lima,PE,B2C,99,777
"""


def test_read_csv_types_and_null_texts(spark, tmp_path):
    path = tmp_path / "customers.csv"
    path.write_text(CUSTOMERS)
    df = read_csv(spark, str(path), "customers")
    first, second, third = df.orderBy(INGEST_ORDER).collect()
    assert (first.customer_id, first.age, first.city) == ("C1", 34, "Rome, north")
    assert first.registration_date == dt.date(2023, 1, 5) and first.state is None
    assert second.registration_date is None and second.age is None
    assert second.gender is None and second.phone is None and second.loyalty_points == -4
    cleaned = {r.customer_id: r for r in cleaning.clean_customers(df).collect()}
    # C1 keeps its first row; C2 has no registration date.
    assert set(cleaned) == {"C1"} and cleaned["C1"].phone == "555"


def test_dates_and_numbers_in_other_forms(spark, tmp_path):
    path = tmp_path / "customers.csv"
    head = CUSTOMERS.split("\n")[0]
    rows = ["A,2024-01-05 10:00:00,3000000000,F,x,y,s,35.7,1", "B,2024-01-05T10:00:00,35.0,F,x,y,s,1e400,1",
            "C,2024/01/05,41,F,x,y,s,-3,1", "D,05.01.2024,41,F,x,y,s,,1", "E,2024-01-05,1,F,\"a\nb\",y,s,2,1"]
    path.write_text("\n".join([head, *rows]) + "\n")
    options = {"multiline": True, "formats": ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy/MM/dd", "dd.MM.yyyy")}
    got = {r.customer_id: r for r in read_csv(spark, str(path), "customers", **options).collect()}
    assert {r.registration_date for r in got.values()} == {dt.date(2024, 1, 5)} and got["E"].city == "a\nb"
    assert (got["A"].age, got["A"].loyalty_points, got["B"].age, got["B"].loyalty_points) == (None, None, 35, None)
    lost = {r.column_name: (r.present, r.unreadable) for r in unreadable(spark, str(path), "customers", multiline=True).collect()}
    assert lost["registration_date"] == (5, 1) and lost["age"] == (5, 1) and lost["loyalty_points"] == (4, 2)


def test_missing_columns_and_files(spark, tmp_path):
    (tmp_path / "customers.csv").write_text("customer_id,age\n1,2\n")
    with pytest.raises(ValueError, match="customers.*gender"):
        load_all(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError, match="no customers table"):
        load_all(spark, str(tmp_path / "nowhere"))


def test_parquet_nan_and_timestamps(spark, tmp_path):
    df = spark.sql(
        "SELECT 'P' payment_id, 'O' order_id, 'C' customer_id, timestamp'2024-01-02 00:00:00' payment_date,"
        " double('NaN') amount, 'card' payment_method, 'Success' payment_status"
    )
    write_table(df, str(tmp_path / "payments.parquet"))
    row = read_parquet(spark, str(tmp_path / "payments.parquet"), "payments").first()
    assert row.amount is None and row.payment_date == dt.date(2024, 1, 2)


def test_keep_first_with_many_copies_and_null_keys(spark):
    rows = [("a", i, i * 1.0) for i in range(1, 2000)] + [("a", 0, -1.0), (None, 3, 1.0), (None, 2, 2.0)]
    df = spark.createDataFrame(rows, f"k string, {INGEST_ORDER} int, v double").repartition(6)
    got = {r.k: r.v for r in cleaning.keep_first(df, ["k"]).collect()}
    assert got == {"a": -1.0, None: 2.0}
    again = cleaning.keep_first(cleaning.keep_first(df, ["k"]), ["k"])
    assert again.count() == 2


def test_exact_duplicates_treat_null_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "x")], "a int, b string")
    assert cleaning.drop_exact_duplicates(df).count() == 2


def test_iqr_capping_by_hand(spark):
    df = spark.createDataFrame([(float(v),) for v in (10, 20, 30, 40, 1000)], "x double")
    # Quartiles 20 and 40: fences -40 and 100.
    assert sorted(r.x for r in cleaning.cap_outliers(df, "x").collect()) == [10, 20, 30, 40, 100]


def test_small_values_are_not_rounded_away(spark):
    df = spark.createDataFrame([(i * 1e-7,) for i in range(100)], "x double")
    assert cleaning.cap_outliers(df, "x").agg(F.max("x")).first()[0] == pytest.approx(99e-7)


def test_median_is_taken_before_rows_without_registration_go(spark):
    rows = [(1, dt.date(2024, 1, 1), None), (2, None, 80), (3, dt.date(2024, 1, 1), 20), (4, None, 81)]
    df = spark.createDataFrame(
        [(i, d, a, None, None, -5) for i, d, a in rows],
        "customer_id int, registration_date date, age int, gender string, phone string, loyalty_points int",
    )
    got = {r.customer_id: r for r in cleaning.clean_customers(df).collect()}
    assert set(got) == {1, 3} and got[1].age == 80
    assert (got[1].gender, got[1].phone, got[1].loyalty_points) == ("Unknown", "N/A", 0)


def test_orders_cleaning(spark):
    df = spark.createDataFrame(
        [("1", "c", "p", dt.date(2024, 1, 1), 0, -1.0, 1.5, -3.0, "x"),
         ("2", None, "p", dt.date(2024, 1, 1), 2, 1.0, 0.1, 5.0, "70")],
        "order_id string, customer_id string, product_id string, order_date date, quantity int,"
        " unit_price double, discount double, total_amount double, delivery_days string",
    )
    (row,) = cleaning.clean_orders(df).collect()
    assert (row.quantity, row.unit_price, row.discount, row.total_amount) == (1, 0.01, 0.99, 0.0)
    assert row.delivery_days is None


def test_profile_counts(spark):
    from retain.sources.bundle import Bundle

    df = spark.createDataFrame([(1, None), (1, None), (2, -0.0), (3, 0.0)], "a int, b double")
    bundle = Bundle(df, df, df, df, df)
    report = {
        r.column_name: r
        for r in profiling.data_quality_report(bundle).filter("table_name = 'orders'").collect()
    }
    assert (report["b"].null_count, report["b"].null_pct, report["b"].unique_vals) == (2, 50.0, 1)
    assert report["a"].duplicate_rows == 1 and report["a"].dtype == "int"
    repeats = profiling.duplicates_by_column(bundle).filter("table_name = 'orders'").collect()
    assert {r.column_name: r.duplicate_values for r in repeats} == {"a": 1, "b": 2}
    empty = df.filter(F.lit(False))
    nulls = profiling.null_counts(Bundle(empty, empty, empty, empty, empty)).first()
    assert nulls.null_pct is None or math.isnan(nulls.null_pct)


def test_columns_outside_the_schema_get_types(spark, tmp_path):
    names = [*REQUIRED["payments"], "tax", "note", "seen", "empty", "big", "ok"]
    lines = [",".join(names)]
    for i in range(6):
        known = {c: str(i) for c in REQUIRED["payments"]} | {"payment_date": "2024-01-02"}
        lines.append(",".join([known[c] for c in REQUIRED["payments"]] + ["" if i == 3 else f"{i}.5", f"{i}x", "2024-02-03", "N/A", " 7 ", "TRUE"]))
    (tmp_path / "payments.csv").write_text("\n".join(lines))
    df = read_csv(spark, str(tmp_path / "payments.csv"), "payments", infer=True)
    kinds = dict(df.dtypes)
    assert [kinds[c] for c in names[-6:]] == ["double", "string", "date", "string", "bigint", "boolean"]
    rows = df.orderBy("payment_id").collect()
    assert [r.tax for r in rows] == [0.5, 1.5, 2.5, None, 4.5, 5.5] and rows[0].big == 7 and rows[0].ok is True and rows[0].empty is None
    assert dict(read_csv(spark, str(tmp_path / "payments.csv"), "payments").dtypes)["tax"] == "string"


def test_votes_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a string, b string")
    got = {r.column_name: (r.present, r.inferred) for r in type_votes(df, ["a", "b"]).collect()}
    assert got == {"a": (0, "string"), "b": (0, "string")}
    odd = spark.createDataFrame([("1d", "Infinity"), ("2", "-1e5"), ("3", ".5")], "a string, b string")
    assert [r.inferred for r in type_votes(odd, ["a", "b"]).orderBy("column_name").collect()] == ["string", "double"]
