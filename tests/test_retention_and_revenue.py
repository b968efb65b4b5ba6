import datetime as dt
import random

from retain.operators import retention, revenue, star

ORDER = "order_id int, customer_id string, order_date date, total_amount double, order_status string, channel string"


def orders(spark, rows):
    return spark.createDataFrame(
        [(i, c, d, a, "Completed", "Web") for i, (c, d, a) in enumerate(rows)], ORDER
    )


def test_two_orders_in_the_first_month_count_as_repeat(spark):
    df = orders(spark, [("a", dt.date(2024, 1, 3), 1.0), ("a", dt.date(2024, 1, 3), 1.0),
                        ("b", dt.date(2024, 1, 9), 1.0), ("b", dt.date(2024, 2, 9), 1.0)])
    got = {r.month: (r.customers, r.repeat_customers, r.retention_rate) for r in retention.monthly_retention(df).collect()}
    assert got == {"2024-01": (2, 1, 50.0), "2024-02": (1, 1, 100.0)}
    assert retention.avg_retention(df).first().avg_retention_rate == 75.0


def test_order_lag_equals_brute_force_with_a_dominant_customer(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.5 else f"c{rng.randrange(40)}", dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(60)), 1.0) for _ in range(800)]
    df = orders(spark, rows)
    got = {r.order_id: r.prev_order_date for r in retention.order_lag(df).collect()}
    want, last = {}, {}
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][1], i)):
        want[i] = last.get(rows[i][0])
        last[rows[i][0]] = rows[i][1]
    assert got == want
    by_rows = retention.retention_rate_rows(df).collect()
    assert sum(r.repeat_orders for r in by_rows) == sum(v is not None for v in want.values())


def test_cohorts_without_first_month_buyers(spark):
    customers = spark.createDataFrame(
        [(c, dt.date(2024, 1, 1)) for c in "abc"] + [("d", dt.date(2024, 2, 1))],
        "customer_id string, registration_date date",
    )
    df = orders(spark, [("a", dt.date(2024, 1, 5), 1.0)] + [(c, dt.date(2024, 2, 5), 1.0) for c in "abc"]
                + [("d", dt.date(2024, 3, 1), 1.0), ("stranger", dt.date(2024, 3, 1), 1.0)])
    got = {(r.cohort_month, r.period_number): r.retention for r in retention.cohort_retention(df, customers).collect()}
    assert got == {("2024-01", 0): 100.0, ("2024-01", 1): 300.0, ("2024-02", 1): None}
    (row,) = retention.cohort_matrix(df, customers).collect()
    assert (row.cohort_month, row.period_0, row.period_1, row.period_2) == ("2024-01", 100.0, 300.0, None)


def test_growth_is_null_after_a_gap(spark):
    df = orders(spark, [("a", dt.date(2024, 1, 31), 100.0), ("a", dt.date(2024, 2, 1), 150.0), ("a", dt.date(2024, 4, 1), 5.0)])
    got = {r.month: r.growth_pct for r in revenue.mom_growth(df).collect()}
    assert got == {"2024-01": None, "2024-02": 50.0, "2024-04": None}
    to_date = {str(r.order_date): r.mtd_revenue for r in revenue.mtd_revenue(df).collect()}
    assert to_date == {"2024-01-31": 100.0, "2024-02-01": 150.0, "2024-04-01": 5.0}


def test_date_dimension_and_slicers(spark):
    df = orders(spark, [("a", dt.date(2024, 2, 28), 1.0), ("a", dt.date(2024, 3, 1), 1.0)])
    assert [str(r.date) for r in star.dim_date(df).orderBy("date").collect()] == ["2024-02-28", "2024-02-29", "2024-03-01"]
    assert star.apply_slicers(df, date_from=dt.date(2024, 3, 1), channels=["Web"]).count() == 1
    assert star.apply_slicers(df).count() == 2
