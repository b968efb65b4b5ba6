"""Independent SQL for each query, over the views region … events.

Each statement is a chain of named steps ending in one SELECT; `statement` puts the steps a
query needs, and those they need in turn, in front of it.
"""

from __future__ import annotations

import re

SNAPSHOT = "DATE '2001-08-01'"

STEPS: dict[str, str] = {}
ORACLE: dict[str, str] = {}

# Source tables --------------------------------------------------------------------------

STEPS["fx_customers"] = """
SELECT c.c_custkey AS customer_id, c.c_name AS first_name, n.n_name AS state, r.r_name AS country,
       CASE WHEN c.c_custkey % 97 = 0 THEN NULL ELSE f.reg END AS registration_date,
       CASE WHEN c.c_custkey % 33 = 0 THEN NULL ELSE CAST(10 + c.c_custkey % 90 AS INT) END AS age,
       CASE WHEN c.c_custkey % 37 = 0 THEN NULL WHEN c.c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
       CASE WHEN c.c_custkey % 31 = 0 THEN NULL ELSE CAST(c.c_custkey AS STRING) END AS phone,
       c.c_mktsegment AS customer_segment,
       CAST(floor(c.c_acctbal) AS INT) AS loyalty_points
FROM customer c
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS reg FROM orders GROUP BY o_custkey) f
  ON f.o_custkey = c.c_custkey
"""

STEPS["fx_orders"] = """
SELECT o_orderkey AS order_id,
       CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE o_custkey END AS customer_id,
       CAST(o_orderdate AS DATE) AS order_date,
       CASE WHEN o_orderkey % 101 = 0 THEN o_totalprice * 20 ELSE o_totalprice END AS total_amount,
       CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Processing' ELSE 'Returned' END AS order_status,
       CASE WHEN o_orderkey % 43 = 0 THEN 'bad' WHEN o_orderstatus <> 'F' THEN NULL
            ELSE CAST(o_orderkey % 75 AS STRING) END AS delivery_days,
       o_orderpriority AS channel
FROM orders
"""

STEPS["fx_lines"] = """
SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_no, o.o_custkey AS customer_id,
       l.l_partkey AS product_id, CAST(o.o_orderdate AS DATE) AS order_date,
       CASE WHEN l.l_orderkey % 61 = 0 THEN -1 ELSE CAST(l.l_quantity AS INT) END AS quantity,
       l.l_extendedprice AS unit_price,
       CASE WHEN l.l_orderkey % 67 = 0 THEN 1.2 ELSE l.l_discount END AS discount,
       l.l_extendedprice AS total_amount,
       CASE o.o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Processing' ELSE 'Returned' END AS order_status,
       o.o_orderpriority AS channel
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

STEPS["fx_products"] = """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS sub_category,
       p_retailprice AS price, p_retailprice * 0.5 AS cost,
       CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE p_size * 10 - 20 END AS stock_qty,
       CAST(p_size % 7 AS DOUBLE) AS rating
FROM part
"""

STEPS["fx_payments"] = """
SELECT o_orderkey * 2 + n AS payment_id, o_orderkey AS order_id, o_custkey AS customer_id,
       CAST(o_orderdate AS DATE) + CAST(n AS INT) AS payment_date,
       CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_orderkey % 59 = 0 THEN -o_totalprice ELSE o_totalprice END AS amount,
       o_orderpriority AS payment_method,
       CASE WHEN o_orderkey % 20 = 0 AND n = 0 THEN 'Failed' WHEN o_orderstatus = 'F' THEN 'Success'
            WHEN o_orderstatus = 'O' THEN 'Pending' ELSE 'Refunded' END AS payment_status
FROM orders, (SELECT unnest([0, 1]) AS n) WHERE n = 0 OR o_orderkey % 40 = 0
"""

STEPS["fx_reviews"] = """
SELECT event_id AS review_id, event_id AS order_id, user_id AS customer_id,
       event_id % (SELECT count(*) FROM part) AS product_id,
       CAST(event_id % 8 AS INT) AS rating,
       CASE WHEN event_id % 20 = 0 THEN NULL ELSE event_type END AS review_text,
       CAST(ts AS DATE) AS review_date
FROM events
"""

COLUMNS = {
    "customers": "customer_id first_name state country registration_date age gender phone customer_segment loyalty_points",
    "orders": "order_id customer_id order_date total_amount order_status delivery_days channel",
    "lines": "order_id line_no customer_id product_id order_date quantity unit_price discount total_amount order_status channel",
    "products": "product_id product_name category sub_category price cost stock_qty rating",
    "payments": "payment_id order_id customer_id payment_date amount payment_method payment_status",
    "reviews": "review_id order_id customer_id product_id rating review_text review_date",
}
COLUMNS = {name: text.split() for name, text in COLUMNS.items()}

DTYPES = {
    "customers": "bigint string string string date int string string string int",
    "orders": "bigint bigint date double string string string",
    "products": "bigint string string string double double int double",
    "payments": "bigint bigint bigint date double string string",
    "reviews": "bigint bigint bigint bigint int string date",
}

CONFLICTS = {
    "customers": ("customer_id", "CAST(-7 AS INT) AS loyalty_points"),
    "orders": ("order_id", "CAST(1 AS DOUBLE) AS total_amount"),
    "products": ("product_id", "CAST(-1 AS DOUBLE) AS price"),
    "payments": ("payment_id", "CAST(1 AS DOUBLE) AS amount"),
    "reviews": ("review_id", "CAST(9 AS INT) AS rating"),
}

for _name, (_key, _other) in CONFLICTS.items():
    STEPS[f"raw_{_name}"] = f"""
SELECT *, 0 AS ingest_ord FROM fx_{_name}
UNION ALL SELECT *, 0 FROM fx_{_name} WHERE {_key} % 50 = 0
UNION ALL SELECT * REPLACE ({_other}), 1 FROM fx_{_name} WHERE {_key} % 70 = 1
"""

# Cleaning -------------------------------------------------------------------------------


def one_per_key(source: str, keys: list[str], order: list[str]) -> str:
    by = ", ".join(f"{c} ASC NULLS FIRST" for c in order)
    return f"""(SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {", ".join(keys)} ORDER BY {by}) AS rn FROM {source}
) WHERE rn = 1)"""


def limited(column: str, low=None, high=None) -> str:
    inner = column
    if low is not None:
        inner = f"greatest({inner}, {low})"
    if high is not None:
        inner = f"least({inner}, {high})"
    return f"CASE WHEN {column} IS NOT NULL THEN {inner} END"


def cleaned(name: str, source: str, duplicates: bool) -> str:
    keys = {"lines": ["order_id", "line_no"], "reviews": ["review_id"]}.get(name, [name[:-1] + "_id"])
    rest = [c for c in COLUMNS[name] if c not in keys]
    base = one_per_key(source, keys, (["ingest_ord"] if duplicates else []) + rest)
    columns = ", ".join(COLUMNS[name])
    if name == "customers":
        return f"""
SELECT {columns} FROM (
  SELECT * REPLACE (
    CAST(trunc(least(greatest(coalesce(CAST(age AS DOUBLE), (SELECT quantile_cont(age, 0.5) FROM {base})), 18), 90)) AS INT) AS age,
    coalesce(gender, 'Unknown') AS gender, coalesce(phone, 'N/A') AS phone,
    {limited("loyalty_points", 0)} AS loyalty_points)
  FROM {base})
WHERE registration_date IS NOT NULL"""
    if name in ("orders", "lines"):
        needed = ["order_id", "customer_id", "order_date"] + (["product_id"] if name == "lines" else [])
        present = " AND ".join(f"{c} IS NOT NULL" for c in needed)
        steps = [f"{limited('total_amount', 0)} AS total_amount"]
        if name == "lines":
            steps += [
                f"{limited('quantity', 1)} AS quantity",
                f"{limited('unit_price', 0.01)} AS unit_price",
                f"{limited('discount', 0, 0.99)} AS discount",
            ]
        low = "(SELECT q1 - 3 * (q3 - q1) FROM quart)"
        high = "(SELECT q3 + 3 * (q3 - q1) FROM quart)"
        last = [f"{limited('total_amount', low, high)} AS total_amount"]
        if name == "orders":
            days = "TRY_CAST(delivery_days AS DOUBLE)"
            last.append(f"{limited(days, 1, 60)} AS delivery_days")
        return f"""
WITH kept AS (SELECT * REPLACE ({", ".join(steps)}) FROM {base} WHERE {present}),
quart AS (SELECT quantile_cont(total_amount, 0.25) AS q1, quantile_cont(total_amount, 0.75) AS q3 FROM kept)
SELECT {columns} FROM (SELECT * REPLACE ({", ".join(last)}) FROM kept)"""
    if name == "products":
        return f"""
SELECT {columns} FROM (SELECT * REPLACE ({limited("price", 0.01)} AS price, {limited("cost", 0.01)} AS cost,
  {limited("rating", 1, 5)} AS rating, coalesce({limited("stock_qty", 0)}, 0) AS stock_qty) FROM {base})"""
    if name == "payments":
        return f"""
SELECT {columns} FROM (SELECT * REPLACE ({limited("amount", 0)} AS amount) FROM {base})
WHERE payment_id IS NOT NULL AND order_id IS NOT NULL AND amount IS NOT NULL"""
    return f"""
SELECT {columns} FROM (SELECT * REPLACE ({limited("rating", 1, 5)} AS rating,
  coalesce(review_text, 'No review text') AS review_text) FROM {base})
WHERE review_id IS NOT NULL AND order_id IS NOT NULL AND customer_id IS NOT NULL"""


for _name in COLUMNS:
    STEPS[f"c_{_name}"] = cleaned(_name, f"fx_{_name}", False)
    if _name != "lines":
        STEPS[f"d_{_name}"] = cleaned(_name, f"raw_{_name}", True)


def money(expr: str) -> str:
    return f"CAST(sum(CAST({expr} AS DECIMAL(28,6))) AS DOUBLE)"


def mean_money(expr: str) -> str:
    return f"{money(expr)} / nullif(count({expr}), 0)"


def even(expr: str, digits: int) -> str:
    factor = 10**digits
    return f"round_even(({expr}) * {factor}.0::DOUBLE, 0) / {factor}.0::DOUBLE"


# Features -------------------------------------------------------------------------------

STEPS["done"] = "SELECT * FROM c_orders WHERE order_status = 'Completed'"
STEPS["done_lines"] = "SELECT * FROM c_lines WHERE order_status = 'Completed'"

STEPS["rfm0"] = f"""
SELECT customer_id, max(order_date) AS last_order_date, min(order_date) AS first_order_date,
       count(order_id) AS frequency, {money("total_amount")} AS monetary
FROM done WHERE customer_id IS NOT NULL GROUP BY customer_id
"""
STEPS["rfm1"] = f"""
SELECT *, CAST({SNAPSHOT} - last_order_date AS INT) AS recency_days,
       CAST(greatest(last_order_date - first_order_date, 1) AS INT) AS customer_lifetime
FROM rfm0
"""
STEPS["rfm2"] = f"""
SELECT *, {even("monetary / frequency", 2)} AS avg_order_value,
       {even("frequency / (CAST(customer_lifetime AS DOUBLE) / 30)", 3)} AS purchase_frequency
FROM rfm1
"""
STEPS["valued"] = f"""
SELECT *, {even("avg_order_value * purchase_frequency * 12", 2)} AS clv,
       CASE WHEN recency_days > 90 THEN 1 ELSE 0 END AS churned
FROM rfm2
"""
STEPS["rev_feat"] = f"""
SELECT customer_id, {even("avg(rating)", 2)} AS avg_review_rating, count(review_id) AS total_reviews
FROM c_reviews GROUP BY customer_id
"""
STEPS["cat_feat"] = """
SELECT customer_id, coalesce(category, 'Unknown') AS favourite_category FROM (
  SELECT customer_id, category,
         row_number() OVER (PARTITION BY customer_id ORDER BY (category IS NULL), count(*) DESC, category) AS rn
  FROM done_lines LEFT JOIN c_products USING (product_id) GROUP BY customer_id, category)
WHERE rn = 1
"""
STEPS["chan_feat"] = """
SELECT customer_id, coalesce(channel, 'Unknown') AS preferred_channel FROM (
  SELECT customer_id, channel,
         row_number() OVER (PARTITION BY customer_id ORDER BY (channel IS NULL), count(*) DESC, channel) AS rn
  FROM done GROUP BY customer_id, channel)
WHERE rn = 1
"""
STEPS["pref"] = "SELECT * FROM cat_feat FULL JOIN chan_feat USING (customer_id)"
STEPS["feat"] = f"""
SELECT c.*, v.last_order_date, v.first_order_date,
       CAST(coalesce(v.frequency, 0) AS BIGINT) AS frequency, coalesce(v.monetary, 0.0) AS monetary,
       coalesce(v.recency_days, CAST({SNAPSHOT} - c.registration_date AS INT)) AS recency_days,
       coalesce(v.customer_lifetime, 0) AS customer_lifetime,
       coalesce(v.avg_order_value, 0.0) AS avg_order_value,
       coalesce(v.purchase_frequency, 0.0) AS purchase_frequency, coalesce(v.clv, 0.0) AS clv,
       coalesce(v.churned, 1) AS churned, coalesce(r.avg_review_rating, 0.0) AS avg_review_rating,
       CAST(coalesce(r.total_reviews, 0) AS BIGINT) AS total_reviews,
       coalesce(p.favourite_category, 'None') AS favourite_category,
       coalesce(p.preferred_channel, 'None') AS preferred_channel
FROM c_customers c LEFT JOIN valued v USING (customer_id)
LEFT JOIN rev_feat r USING (customer_id) LEFT JOIN pref p USING (customer_id)
"""

# Segments -------------------------------------------------------------------------------


def score(column: str, alias: str, partition: str = "") -> str:
    return " + ".join(
        f"CASE WHEN {column} > {even(f'{alias}[{i}]', 9)} THEN 1 ELSE 0 END" for i in range(1, 5)
    )


def edges(column: str) -> str:
    return f"quantile_cont(CAST({column} AS DOUBLE), [0.2, 0.4, 0.6, 0.8])"


NAMED = """CASE WHEN R_score >= 4 AND F_score >= 4 AND M_score >= 4 THEN 'Champions'
     WHEN F_score >= 4 AND M_score >= 4 THEN 'Loyal Customers'
     WHEN R_score >= 4 AND F_score <= 2 THEN 'New Customers'
     WHEN R_score <= 2 AND F_score >= 3 THEN 'At Risk'
     WHEN R_score + F_score + M_score <= 5 THEN 'Lost'
     ELSE 'Potential Loyalists' END"""

STEPS["edge"] = f"""
SELECT {edges("recency_days")} AS re, {edges("frequency")} AS fe, {edges("monetary")} AS me FROM feat
"""
STEPS["scored"] = f"""
SELECT feat.*, CAST(5 - ({score("recency_days", "re")}) AS INT) AS R_score,
       CAST(1 + {score("frequency", "fe")} AS INT) AS F_score,
       CAST(1 + {score("monetary", "me")} AS INT) AS M_score
FROM feat CROSS JOIN edge
"""
STEPS["seg"] = f"SELECT *, R_score + F_score + M_score AS RFM_score, {NAMED} AS rfm_segment FROM scored"

STEPS["km_in"] = """
SELECT customer_id, ln(1 + (SELECT max(recency_days) FROM feat) - recency_days) AS recency_days,
       ln(1 + frequency) AS frequency, ln(1 + monetary) AS monetary FROM feat
"""

_last_paid = "(payment_status = 'Success', payment_date, payment_id)"

# Months and cohorts ---------------------------------------------------------------------

STEPS["by_month"] = f"""
SELECT CAST(date_trunc('month', order_date) AS DATE) AS m, {money("total_amount")} AS revenue
FROM done GROUP BY 1
"""
STEPS["lagged"] = """
SELECT *, lag(order_date) OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS prev_order_date
FROM done WHERE customer_id IS NOT NULL
"""
STEPS["retained"] = f"""
SELECT strftime(order_date, '%Y-%m') AS month, count(DISTINCT customer_id) AS customers,
       count(DISTINCT customer_id) FILTER (WHERE prev_order_date IS NOT NULL) AS repeat_customers,
       {even("count(DISTINCT customer_id) FILTER (WHERE prev_order_date IS NOT NULL) / count(DISTINCT customer_id) * 100", 6)} AS retention_rate
FROM lagged GROUP BY 1
"""
STEPS["periods"] = """
SELECT strftime(c.registration_date, '%Y-%m') AS cohort_month,
       CAST((year(o.order_date) * 12 + month(o.order_date)) - (year(c.registration_date) * 12 + month(c.registration_date)) AS INT) AS period_number,
       o.customer_id
FROM done o JOIN c_customers c USING (customer_id)
"""
STEPS["cohort"] = f"""
SELECT a.cohort_month, a.period_number, a.customers, b.customers AS cohort_size,
       {even("a.customers / b.customers * 100", 1)} AS retention
FROM (SELECT cohort_month, period_number, count(DISTINCT customer_id) AS customers FROM periods
      WHERE period_number >= 0 GROUP BY 1, 2) a
LEFT JOIN (SELECT cohort_month, count(DISTINCT customer_id) AS customers FROM periods
      WHERE period_number = 0 GROUP BY 1) b ON a.cohort_month = b.cohort_month
"""
STEPS["prod_rev"] = f"""
SELECT p.product_id, p.product_name, p.category, {money("l.total_amount")} AS revenue
FROM done_lines l JOIN c_products p USING (product_id) GROUP BY 1, 2, 3
"""
STEPS["paid"] = f"""
SELECT order_id, count(*) AS payments, {money("CASE WHEN payment_status = 'Success' THEN amount ELSE 0 END")} AS paid_amount,
       arg_max(payment_method, {_last_paid}) AS payment_method, arg_max(payment_status, {_last_paid}) AS payment_status
FROM c_payments GROUP BY order_id
"""
STEPS["star"] = """
SELECT l.order_id, l.line_no, l.order_date, CAST(year(l.order_date) AS INT) AS year,
       strftime(l.order_date, '%Y-%m') AS year_month, l.customer_id, c.customer_segment, c.state, c.country AS region,
       l.product_id, p.product_name, p.category, y.payment_method, y.payment_status,
       CAST(coalesce(y.payments, 0) AS BIGINT) AS payments, y.paid_amount,
       l.quantity, l.discount, l.total_amount, l.order_status, l.channel
FROM c_lines l LEFT JOIN c_customers c USING (customer_id) LEFT JOIN c_products p USING (product_id)
LEFT JOIN paid y ON y.order_id = l.order_id
"""
STEPS["card"] = f"""
SELECT * FROM
 (SELECT {even(money("total_amount"), 2)} AS total_revenue,
         {even(money("total_amount") + " / count(order_id)", 2)} AS avg_order_value FROM done),
 (SELECT count(*) FILTER (WHERE churned = 0) AS active_customers,
         {even("count(*) FILTER (WHERE churned = 0) / count(*) * 100", 4)} AS active_pct,
         {even("avg(churned) * 100", 4)} AS churn_rate_pct,
         {even(mean_money("CASE WHEN frequency > 0 THEN clv END"), 2)} AS avg_clv,
         {even("coalesce(" + money("CASE WHEN rfm_segment = 'At Risk' THEN monetary END") + ", 0)", 2)} AS revenue_at_risk FROM seg),
 (SELECT {even("avg(rating)", 4)} AS avg_rating FROM c_reviews)
"""
STEPS["growth"] = f"""
SELECT strftime(a.m, '%Y-%m') AS month, {even("a.revenue", 2)} AS revenue, {even("b.revenue", 2)} AS prev_revenue,
       {even("(a.revenue - b.revenue) / nullif(b.revenue, 0) * 100", 4)} AS growth_pct
FROM by_month a LEFT JOIN by_month b ON b.m = CAST(a.m - INTERVAL 1 MONTH AS DATE)
"""
STEPS["pred"] = """
SELECT customer_id, churned AS label, ((customer_id * 7919 + recency_days * 104729) % 1000) / 1000.0::DOUBLE AS score,
       CASE WHEN ((customer_id * 7919 + recency_days * 104729) % 1000) / 1000.0::DOUBLE >= 0.5 THEN 1 ELSE 0 END AS prediction
FROM feat
"""


def statement(select: str) -> str:
    """The SELECT with every step it names, in dependency order, in front."""
    order: list[str] = []

    def need(sql: str) -> None:
        for name in STEPS:
            if name not in order and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql):
                need(STEPS[name])
                if name not in order:
                    order.append(name)

    need(select)
    if not order:
        return select
    steps = ",\n".join(f"{name} AS ({STEPS[name].strip()})" for name in order)
    return f"WITH {steps}\n{select.strip()}"


def check(name: str, select: str) -> None:
    ORACLE[name] = statement(select)


def as_text(step: str, *dates: str, where: str = "") -> str:
    swaps = ", ".join(f"CAST({d} AS VARCHAR) AS {d}" for d in dates)
    return f"SELECT * REPLACE ({swaps}) FROM {step} {where}" if dates else f"SELECT * FROM {step} {where}"


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# Sources and profile --------------------------------------------------------------------

_dated = {"customers": "registration_date", "orders": "order_date", "payments": "payment_date", "reviews": "review_date"}
_summed = {"customers": "age", "orders": "total_amount", "products": "price", "payments": "amount", "reviews": "rating"}
check("scan_counts", union([
    f"SELECT '{n}' AS table_name, count(*) AS rows, CAST({f'count({_dated[n]})' if n in _dated else 0} AS BIGINT) AS dated, {money(c)} AS total FROM fx_{n}"
    for n, c in _summed.items()
]))
_damaged = [
    ("order_date", "count(*) FILTER (WHERE order_id % 41 = 0 OR order_id % 43 = 0 OR order_id % 47 <> 0)",
     "count(*) FILTER (WHERE order_id % 41 = 0 OR order_id % 43 = 0)"),
    ("total_amount", "count(*) FILTER (WHERE order_id % 31 = 0 OR total_amount IS NOT NULL)", "count(*) FILTER (WHERE order_id % 31 = 0)"),
]
check("landed_columns", union([
    f"SELECT 'orders' AS table_name, '{c}' AS column_name, CAST({p} AS BIGINT) AS present, CAST({u} AS BIGINT) AS unreadable FROM fx_orders"
    for c, p, u in _damaged
]))
check("null_tokens", """
SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 7 > 3 THEN c_mktsegment END AS customer_segment FROM customer""")
check("parse_dates", """
SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 41 > 2 THEN strftime(o_orderdate, '%Y-%m-%d') END AS order_date FROM orders""")
_all, _none = "count(*)", "count(*) FILTER (WHERE FALSE)"
check("inferred_types", union([
    f"SELECT '{c}' AS column_name, CAST({n} AS BIGINT) AS present, CAST({b} AS BIGINT) AS fits_boolean, CAST({w} AS BIGINT) AS fits_bigint, "
    f"CAST({x} AS BIGINT) AS fits_double, CAST({d} AS BIGINT) AS fits_date, '{kind}' AS inferred FROM customer"
    for c, n, b, w, x, d, kind in (
        ("whole", _all, _none, _all, _all, _none, "bigint"),
        ("gaps", *["count(*) FILTER (WHERE c_custkey % 3 > 0)" if v else _none for v in (1, 0, 1, 1, 0)], "bigint"),
        ("amount", _all, _none, _none, _all, _none, "double"),
        ("either", _all, _none, "count(*) FILTER (WHERE c_custkey % 2 = 0)", _all, _none, "double"),
        ("day", _all, _none, _none, _none, _all, "date"),
        ("not_day", _all, _none, _none, _none, "count(*) FILTER (WHERE c_custkey % 7 > 0)", "string"),
        ("flag", _all, _all, _none, _none, _none, "boolean"),
        ("mixed", _all, _none, *["count(*) FILTER (WHERE c_custkey % 5 > 0)"] * 2, _none, "string"),
        ("nothing", _none, _none, _none, _none, _none, "string"),
        ("beyond", _all, _none, _none, _all, _none, "double"),
    )
]))
check("table_summary", union([
    f"SELECT '{n.capitalize()}' AS table_name, count(*) AS rows, {len(COLUMNS[n])} AS columns FROM raw_{n}" for n in DTYPES
]))


def per_column(template: str) -> str:
    return union([
        template.format(t=n, c=c, d=d)
        for n in DTYPES for c, d in zip(COLUMNS[n], DTYPES[n].split(), strict=True)
    ])


_null_pct = even("count(*) FILTER (WHERE {c} IS NULL) / count(*) * 100", 2)
_nulls = "SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, " + _null_pct + " AS null_pct FROM raw_{t}"
check("dq_nulls", per_column(_nulls))
check("dq_distinct_sketch", per_column(
    "SELECT '{t}' AS table_name, '{c}' AS column_name, count(DISTINCT {c}) AS unique_vals, TRUE AS within_error FROM raw_{t}"))
check("dq_distinct", per_column(
    "SELECT '{t}' AS table_name, '{c}' AS column_name, count(DISTINCT {c}) AS unique_vals FROM raw_{t}"))
check("dq_dup_by_column", per_column(
    "SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(count(*) - count(DISTINCT {c}) - max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS duplicate_values FROM raw_{t}"))


def repeats(n: str) -> str:
    columns = ", ".join(COLUMNS[n])
    return f"(SELECT CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM raw_{n} GROUP BY {columns}))"


check("dq_dup_rows", union([f"SELECT '{n}' AS table_name, {repeats(n)} AS duplicate_rows" for n in DTYPES]))
_missing = per_column(_nulls + " HAVING count(*) FILTER (WHERE {c} IS NULL) > 0")
_sizes = union([f"SELECT '{n}' AS table_name, count(*) AS rows, {repeats(n)} AS duplicate_rows FROM raw_{n}" for n in DTYPES])
check("dq_warnings", f"""
SELECT t.table_name, t.rows, t.duplicate_rows, m.column_name, m.null_count, m.null_pct
FROM ({_sizes}) t LEFT JOIN ({_missing}) m ON m.table_name = t.table_name""")
check("dq_report", union([
    (f"SELECT '{n}' AS table_name, '{c}' AS column_name, '{d}' AS dtype, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
     + _null_pct.format(c=c) + f" AS null_pct, count(DISTINCT {c}) AS unique_vals, {repeats(n)} AS duplicate_rows FROM raw_{n}")
    for n in DTYPES for c, d in zip(COLUMNS[n], DTYPES[n].split(), strict=True)
]))

# Cleaning -------------------------------------------------------------------------------

check("cleaning_summary", union([
    f"SELECT '{n.capitalize()}' AS table_name, b AS rows_before, a AS rows_after, b - a AS rows_removed FROM (SELECT count(*) AS b FROM raw_{n}), (SELECT count(*) AS a FROM d_{n})"
    for n in DTYPES
]))
ORACLE["landed_summary"] = ORACLE["cleaning_summary"]
check("dedupe_rows", "SELECT DISTINCT * REPLACE (CAST(payment_date AS VARCHAR) AS payment_date) FROM (SELECT * EXCLUDE (ingest_ord) FROM raw_payments)")
check("dedupe_keep_first", as_text(
    one_per_key("fx_lines", ["order_id", "line_no"], [c for c in COLUMNS["lines"] if c not in ("order_id", "line_no")]), "order_date"))
check("drop_null_keys", "SELECT order_id, customer_id, CAST(order_date AS VARCHAR) AS order_date FROM fx_orders WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND order_date IS NOT NULL")
check("fill_constants", "SELECT customer_id, coalesce(gender, 'Unknown') AS gender, coalesce(phone, 'N/A') AS phone FROM fx_customers")
check("impute_median", "SELECT customer_id, coalesce(CAST(age AS DOUBLE), (SELECT quantile_cont(age, 0.5) FROM fx_customers)) AS age FROM fx_customers")
check("clip_ranges", f"SELECT review_id, {limited('rating', 1, 5)} AS rating FROM fx_reviews")
check("clip_lower", f"SELECT order_id, line_no, {limited('quantity', 1)} AS quantity, {limited('unit_price', 0.01)} AS unit_price FROM fx_lines")
check("coerce_numeric", "SELECT order_id, TRY_CAST(delivery_days AS DOUBLE) AS delivery_days FROM fx_orders")
_q = "(SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {t})"
check("iqr_cap", f"""
SELECT order_id, {even("least(greatest(total_amount, q1 - 3 * (q3 - q1)), q3 + 3 * (q3 - q1))", 6)} AS total_amount
FROM fx_orders, {_q.format(c="total_amount", t="fx_orders")}""")
check("iqr_fences", f"""
SELECT {even("q1", 4)} AS q1, {even("q3", 4)} AS q3, {even("q1 - 3 * (q3 - q1)", 4)} AS lower_fence,
       {even("q3 + 3 * (q3 - q1)", 4)} AS upper_fence FROM {_q.format(c="value", t="events")}""")
check("clean_customers", as_text("d_customers", "registration_date"))
_six = even("total_amount", 6)  # engines differ in the last bit of an interpolated fence
check("clean_orders", as_text(f"(SELECT * REPLACE ({_six} AS total_amount) FROM d_orders)", "order_date"))
check("clean_order_lines", as_text(f"(SELECT * REPLACE ({_six} AS total_amount) FROM c_lines)", "order_date"))
check("clean_products", as_text("d_products"))
check("clean_payments", as_text("d_payments", "payment_date"))
check("clean_reviews", as_text("d_reviews", "review_date"))

# Features and segments ------------------------------------------------------------------

check("completed_orders", as_text("fx_orders", "order_date", where="WHERE order_status = 'Completed'"))
check("rfm", as_text("rfm2", "last_order_date", "first_order_date"))
check("clv", "SELECT customer_id, avg_order_value, purchase_frequency, clv FROM valued")
check("churn_flag", "SELECT customer_id, recency_days, churned FROM valued")
check("review_features", "SELECT * FROM rev_feat")
check("category_channel_features", "SELECT customer_id, favourite_category, preferred_channel FROM pref")
check("customer_features", as_text("feat", "registration_date", "last_order_date", "first_order_date"))
ORACLE["stored_features"] = ORACLE["customer_features"]
check("feature_export", as_text("feat", "registration_date", "last_order_date", "first_order_date"))
check("feature_sample", "SELECT customer_id, recency_days, frequency, monetary, avg_order_value, clv, churned FROM feat ORDER BY customer_id LIMIT 10")
check("feature_summary", f"""
SELECT count(*) AS customers, CAST(sum(churned) AS BIGINT) AS churned, {even("avg(churned) * 100", 4)} AS churned_pct,
       {even(mean_money("clv"), 2)} AS avg_clv, {even("avg(recency_days)", 4)} AS avg_recency_days,
       {even("avg(frequency)", 4)} AS avg_frequency, {even(mean_money("monetary"), 2)} AS avg_monetary FROM feat""")
check("rfm_scores", "SELECT customer_id, R_score, F_score, M_score, RFM_score FROM seg")
check("rfm_segments", "SELECT customer_id, RFM_score, rfm_segment FROM seg")


def counted(column: str, source: str) -> str:
    share = even(f"count(*) / (SELECT count(*) FROM {source}) * 100", 4)
    return f"SELECT {column}, count(*) AS customers, {share} AS pct FROM {source} GROUP BY {column}"


check("segment_counts", counted("rfm_segment", "seg"))
check("customer_segment_counts", counted("customer_segment", "c_customers"))
check("churn_counts", f"""
SELECT CASE WHEN churned = 1 THEN 'Churned' ELSE 'Active' END AS status, count(*) AS customers,
       {even("count(*) / (SELECT count(*) FROM feat) * 100", 4)} AS pct FROM feat GROUP BY 1""")
_clv = f"SELECT rfm_segment, {even(mean_money('clv'), 2)} AS avg_clv, {even(money('clv'), 2)} AS total_clv FROM seg"
check("clv_by_segment", _clv + " GROUP BY 1")
check("clv_by_segment_active", _clv + " WHERE clv > 0 GROUP BY 1")
check("segment_summary", f"""
SELECT rfm_segment, count(customer_id) AS customers, {even("avg(recency_days)", 2)} AS avg_recency,
       {even("avg(frequency)", 2)} AS avg_frequency, {even(mean_money("monetary"), 2)} AS avg_monetary,
       {even(mean_money("clv"), 2)} AS avg_clv, {even("avg(churned)", 2)} AS churn_rate FROM seg GROUP BY 1""")
check("churn_by_segment", f"""
SELECT rfm_segment, count(*) AS customers, CAST(sum(churned) AS BIGINT) AS churned,
       {even("avg(churned) * 100", 4)} AS churn_pct FROM seg GROUP BY 1""")
check("rfm_scatter", "SELECT customer_id, recency_days, monetary, rfm_segment FROM seg WHERE monetary > 0 ORDER BY (customer_id * 7919) % 10007, customer_id LIMIT 500")
check("kmeans_inputs", f"SELECT customer_id, {even('recency_days', 6)} AS recency_days, {even('frequency', 6)} AS frequency, {even('monetary', 6)} AS monetary FROM km_in")
check("kmeans_scaled", "SELECT customer_id, " + ", ".join(
    even(f"({c} - (SELECT avg({c}) FROM km_in)) / (SELECT stddev_pop({c}) FROM km_in)", 4) + f" AS {c}"
    for c in ("recency_days", "frequency", "monetary")) + " FROM km_in")

_centres = ((-1, -1, -1), (0, 0, 0), (1, 1, 1), (1, -1, 0))
STEPS["km_scaled"] = "SELECT customer_id, " + ", ".join(
    even(f"({c} - (SELECT avg({c}) FROM km_in)) / (SELECT stddev_pop({c}) FROM km_in)", 4) + f" AS {c}"
    for c in ("recency_days", "frequency", "monetary")) + " FROM km_in"
_distances = ", ".join(f"(recency_days - ({a})) ** 2 + (frequency - ({b})) ** 2 + (monetary - ({c})) ** 2" for a, b, c in _centres)
STEPS["km_near"] = f"SELECT customer_id, list_position(d, list_min(d)) - 1 AS kmeans_cluster FROM (SELECT customer_id, [{_distances}] AS d FROM km_scaled)"
_medians = ", ".join(f"{even(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)', 6)} AS median_{c}" for c in ("recency_days", "frequency", "monetary"))
check("kmeans_given_centres", f"""
SELECT *, ['Champions', 'Loyal Customers', 'Potential Loyalists', 'At Risk', 'Lost'][row_number() OVER (ORDER BY median_monetary DESC, kmeans_cluster)] AS kmeans_segment
FROM (SELECT CAST(kmeans_cluster AS INT) AS kmeans_cluster, count(*) AS customers, {_medians} FROM feat JOIN km_near USING (customer_id) GROUP BY 1)""")

# Revenue and retention ------------------------------------------------------------------

check("monthly_revenue", f"SELECT strftime(m, '%Y-%m') AS month, {even('revenue', 2)} AS revenue FROM by_month")
check("stored_period_revenue", f"""
SELECT strftime(order_date, '%Y-%m') AS month, {even(money("total_amount"), 2)} AS revenue
FROM done WHERE order_date BETWEEN DATE '1996-01-15' AND DATE '1997-03-10' GROUP BY 1""")
_summary = f"""
SELECT strftime(order_date, '%Y-%m') AS month, {even(money("total_amount"), 2)} AS revenue, CAST(count(order_id) AS BIGINT) AS orders,
       count(DISTINCT customer_id) AS customers, {even(money("total_amount") + " / count(order_id)", 2)} AS avg_order_value
FROM done GROUP BY 1"""
check("monthly_summary", _summary)
check("monthly_summary_tail", _summary + " ORDER BY month DESC LIMIT 6")
check("mom_growth", "SELECT * FROM growth")
check("mtd_revenue", f"""
SELECT CAST(order_date AS VARCHAR) AS order_date, {even("CAST(d AS DOUBLE)", 2)} AS revenue,
       {even("CAST(sum(d) OVER (PARTITION BY date_trunc('month', order_date) ORDER BY order_date) AS DOUBLE)", 2)} AS mtd_revenue
FROM (SELECT order_date, sum(CAST(total_amount AS DECIMAL(28,6))) AS d FROM done GROUP BY 1)""")
check("order_lag", "SELECT order_id, customer_id, CAST(order_date AS VARCHAR) AS order_date, CAST(prev_order_date AS VARCHAR) AS prev_order_date FROM lagged")
check("monthly_retention", "SELECT * FROM retained")
check("avg_retention", f"SELECT count(*) AS months, {even('avg(retention_rate)', 4)} AS avg_retention_rate FROM retained")
check("retention_rate_rows", f"""
SELECT strftime(order_date, '%Y-%m') AS month, CAST(count(prev_order_date) AS BIGINT) AS repeat_orders,
       count(DISTINCT customer_id) AS customers, {even("count(prev_order_date) / count(DISTINCT customer_id)", 6)} AS rate
FROM lagged GROUP BY 1""")
check("cohort_retention", "SELECT * FROM cohort")
check("cohort_matrix", "SELECT cohort_month, " + ", ".join(
    f"max(CASE WHEN period_number = {p} THEN retention END) AS period_{p}" for p in range(12)
) + " FROM cohort WHERE retention IS NOT NULL GROUP BY 1 ORDER BY 1 DESC LIMIT 12")
for _n, _key in ((15, "top_products"), (10, "top_products_10")):
    check(_key, f"SELECT product_id, product_name, category, {even('p.revenue', 2)} AS revenue FROM prod_rev p ORDER BY p.revenue DESC, product_id LIMIT {_n}")
check("revenue_by_category", f"SELECT category, {even(money('total_amount'), 2)} AS revenue FROM done_lines JOIN c_products USING (product_id) GROUP BY 1")
check("revenue_by_channel", f"SELECT channel, count(*) AS orders, {even(money('total_amount'), 2)} AS revenue FROM done GROUP BY 1")

# KPIs, star schema and dashboard tables -------------------------------------------------

check("kpis", "SELECT * FROM card")
_targets = [
    ("revenue_growth_pct", ">=", "5.0"), ("active_pct", ">", "60.0"), ("churn_rate_pct", "<", "40.0"),
    ("avg_clv", ">", "500.0"), ("avg_order_value", ">", "100.0"), ("avg_retention_rate", ">", "45.0"),
    ("avg_rating", ">", "4.0"), ("revenue_at_risk", "minimise", None),
]
_source = f"""(SELECT * FROM card, (SELECT growth_pct AS revenue_growth_pct FROM growth ORDER BY month DESC LIMIT 1),
  (SELECT {even("avg(retention_rate)", 4)} AS avg_retention_rate FROM retained))"""
check("kpi_targets", union([
    f"SELECT '{k}' AS kpi, CAST({k} AS DOUBLE) AS value, '{d}' AS direction, CAST({t or 'NULL'} AS DOUBLE) AS target, "
    f"{f'{k} {d} {t}' if t else 'CAST(NULL AS BOOLEAN)'} AS met FROM {_source}"
    for k, d, t in _targets
]))
_first = "(SELECT {c} FROM {t} GROUP BY {c} ORDER BY {o} DESC, {c} LIMIT 1)"
STEPS["found"] = f"""
SELECT (SELECT {even(money("total_amount"), 2)} FROM done) AS total_revenue,
       {even("avg(churned) * 100", 4)} AS churn_rate_pct,
       {even(mean_money("CASE WHEN clv > 0 THEN clv END"), 2)} AS avg_clv,
       {even(money("CASE WHEN rfm_segment = 'Champions' THEN monetary END") + " / " + money("monetary") + " * 100", 4)} AS champions_revenue_pct,
       {even(mean_money("CASE WHEN rfm_segment = 'Champions' THEN clv END"), 2)} AS champions_avg_clv,
       count(*) FILTER (WHERE rfm_segment = 'At Risk') AS at_risk_customers,
       {_first.format(c="rfm_segment", t="seg", o="avg(clv)")} AS top_segment_by_clv,
       {_first.format(c="channel", t="done", o="count(*)")} AS top_channel,
       {_first.format(c="category", t="done_lines JOIN c_products USING (product_id)", o="count(*)")} AS top_category_by_purchases,
       {_first.format(c="category", t="done_lines JOIN c_products USING (product_id)", o="sum(CAST(total_amount AS DECIMAL(28,6)))")} AS top_category_by_revenue
FROM seg
"""
check("insights", "SELECT * FROM found")
check("insight_sentences", """
SELECT CAST(i AS INT) AS position, sentences[i + 1] AS sentence FROM (SELECT unnest(range(5)) AS i),
(SELECT [
  printf('%.1f%% of customers have churned; winning back the %d ''At Risk'' customers comes first.', churn_rate_pct, at_risk_customers),
  printf('Champions bring %.0f%% of all spend with an average lifetime value of $%s.', champions_revenue_pct,
         format('{:,}', CAST(round(champions_avg_clv) AS BIGINT))),
  printf('Completed orders earned $%s; most of them came through ''%s''.', format('{:,}', CAST(round(total_revenue) AS BIGINT)), top_channel),
  printf('The average lifetime value of buyers is $%s.%02d, highest in the segment ''%s''.',
         format('{:,}', CAST(floor(round(avg_clv * 100) / 100) AS BIGINT)), CAST(round(avg_clv * 100) AS BIGINT) % 100, top_segment_by_clv),
  printf('''%s'' is bought most often; ''%s'' earns most.', top_category_by_purchases, top_category_by_revenue)
] AS sentences FROM found)""")
check("customer_funnel", union([
    f"SELECT {i} AS step, '{s}' AS stage, count(*) AS customers FROM feat WHERE {w}"
    for i, s, w in ((1, "New", "true"), (2, "Active", "frequency >= 1"), (3, "Returning", "frequency >= 2"), (4, "Churned", "churned = 1"))
]))
check("rating_by_category", f"""
SELECT category, CAST(count(review_id) AS BIGINT) AS reviews, {even("avg(r.rating)", 4)} AS avg_rating
FROM c_reviews r JOIN c_products p USING (product_id) GROUP BY 1""")
check("revenue_discount_corr", f"""
SELECT discount, count(*) AS purchases, {even(money("total_amount"), 2)} AS revenue, {even(mean_money("total_amount"), 2)} AS avg_revenue,
       (SELECT {even("corr(discount, total_amount)", 4)} FROM done_lines) AS correlation FROM done_lines GROUP BY 1""")
check("stock_vs_demand", f"""
SELECT p.product_id, p.category, p.stock_qty, CAST(coalesce(s.u, 0) AS BIGINT) AS units_sold,
       {even("p.stock_qty / nullif(CAST(s.u AS DOUBLE), 0)", 4)} AS stock_per_unit_sold
FROM c_products p LEFT JOIN (SELECT product_id, sum(quantity) AS u FROM done_lines GROUP BY 1) s USING (product_id)""")
check("clv_vs_frequency", f"SELECT frequency, count(*) AS customers, {even(mean_money('clv'), 2)} AS avg_clv FROM feat GROUP BY 1")
_projection = "SELECT customer_id, avg_order_value, purchase_frequency, clv, rfm_segment FROM seg"
check("clv_projection", _projection)
check("top_customers_clv", _projection + " ORDER BY clv DESC, customer_id LIMIT 50")
check("dim_date", """
SELECT strftime(d, '%Y-%m-%d') AS date, CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month,
       strftime(d, '%Y-%m') AS year_month, CAST(day(d) AS INT) AS day
FROM (SELECT unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS d FROM fx_orders)""")
check("star_fact", as_text(f"(SELECT * REPLACE ({_six} AS total_amount) FROM star)", "order_date"))
check("sliced_revenue", f"""
SELECT year_month, channel, count(*) AS purchases, {even(money("total_amount"), 2)} AS revenue FROM star
WHERE order_date BETWEEN DATE '1999-01-01' AND DATE '2000-12-31' AND customer_segment IN ('BUILDING', 'MACHINERY')
  AND category IN ('ECONOMY', 'STANDARD', 'PROMO') AND channel IN ('1-URGENT', '2-HIGH')
  AND state IN ({", ".join(f"'NATION_{i}'" for i in range(20))}) AND region IN ('AMERICA', 'ASIA', 'EUROPE') GROUP BY 1, 2""")

STEPS["ends"] = """
SELECT year(m) * 12 + month(m) AS i, CAST(last_day(m) AS DATE) AS as_of
FROM (SELECT unnest(generate_series(date_trunc('month', min(order_date)), DATE '2001-07-01', INTERVAL 1 MONTH)) AS m FROM done)
"""
STEPS["snap"] = f"""
SELECT e.i, e.as_of, d.customer_id, CAST(e.as_of - max(d.order_date) AS INT) AS recency_days,
       count(d.order_id) AS frequency, {money("d.total_amount")} AS monetary
FROM ends e JOIN done d ON d.order_date <= e.as_of GROUP BY 1, 2, 3
"""
STEPS["snap_edge"] = f"SELECT i, {edges('recency_days')} AS re, {edges('frequency')} AS fe, {edges('monetary')} AS me FROM snap GROUP BY 1"
STEPS["snap_seg"] = f"""
SELECT i, as_of, customer_id, {NAMED} AS segment FROM (
  SELECT s.*, 5 - ({score("recency_days", "re")}) AS R_score, 1 + {score("frequency", "fe")} AS F_score,
         1 + {score("monetary", "me")} AS M_score
  FROM snap s JOIN snap_edge USING (i))
"""
check("segment_migration", """
SELECT strftime(b.as_of, '%Y-%m') AS month, a.segment AS from_segment, b.segment AS to_segment, count(*) AS customers
FROM snap_seg b JOIN snap_seg a ON a.customer_id = b.customer_id AND a.i = b.i - 1 GROUP BY 1, 2, 3""")

# Statistics -----------------------------------------------------------------------------

check("describe_customers", union([
    f"""SELECT '{c}' AS column_name, count({c}) AS count, {even(f"avg({c})", 6)} AS mean, {even(f"stddev_samp({c})", 6)} AS std,
    CAST(min({c}) AS DOUBLE) AS min, {even(f"quantile_cont({c}, 0.25)", 6)} AS p25, {even(f"quantile_cont({c}, 0.5)", 6)} AS p50,
    {even(f"quantile_cont({c}, 0.75)", 6)} AS p75, CAST(max({c}) AS DOUBLE) AS max FROM c_customers"""
    for c in ("age", "loyalty_points")
]))


def binned(source: str, bins: int) -> str:
    return f"""
SELECT CAST(b AS INT) AS bin, {even("lo + w * b", 4)} AS bin_from, {even("lo + w * (b + 1)", 4)} AS bin_to,
       count(x) AS customers
FROM (SELECT unnest(range({bins})) AS b, lo, w FROM (SELECT min(x) AS lo, (max(x) - min(x)) / {bins} AS w FROM {source}))
LEFT JOIN {source} ON CAST(least(floor((x - lo) / w), {bins - 1}) AS INT) = b
GROUP BY b, lo, w"""


STEPS["ages"] = "SELECT CAST(age AS DOUBLE) AS x FROM c_customers"
STEPS["clvs"] = f"SELECT least(clv, (SELECT quantile_cont(clv, 0.95) FROM feat WHERE clv > 0)) AS x FROM feat WHERE clv > 0"
check("age_histogram", binned("ages", 20))
check("clv_histogram", binned("clvs", 40))
_fences = "(SELECT churned, quantile_cont(clv, 0.25) AS a, quantile_cont(clv, 0.75) AS b FROM feat WHERE clv > 0 GROUP BY 1)"
check("clv_box_by_churn", f"""
SELECT churned, {even("min(clv)", 6)} AS min, {even("quantile_cont(clv, 0.25)", 6)} AS q1, {even("quantile_cont(clv, 0.5)", 6)} AS median,
       {even("quantile_cont(clv, 0.75)", 6)} AS q3, {even("max(clv)", 6)} AS max, count(clv) AS customers,
       min(clv) FILTER (WHERE clv >= a - 1.5 * (b - a)) AS whisker_low, max(clv) FILTER (WHERE clv <= b + 1.5 * (b - a)) AS whisker_high
FROM feat JOIN {_fences} USING (churned) WHERE clv > 0 GROUP BY 1""")

check("amount_box_by_customer", f"""
SELECT customer_id, {even("min(total_amount)", 6)} AS min, {even("any_value(a)", 6)} AS q1, {even("quantile_cont(total_amount, 0.5)", 6)} AS median,
       {even("any_value(b)", 6)} AS q3, {even("max(total_amount)", 6)} AS max, count(total_amount) AS customers,
       {even("min(total_amount) FILTER (WHERE total_amount >= a - 1.5 * (b - a))", 6)} AS whisker_low,
       {even("max(total_amount) FILTER (WHERE total_amount <= b + 1.5 * (b - a))", 6)} AS whisker_high
FROM c_orders JOIN (SELECT customer_id, quantile_cont(total_amount, 0.25) AS a, quantile_cont(total_amount, 0.75) AS b FROM c_orders GROUP BY 1)
     USING (customer_id) GROUP BY 1""")


def correlation(a: str, b: str) -> str:
    return f"CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 THEN {even(f'corr({a}, {b})', 4)} END"


NUMERIC = "age recency_days frequency monetary avg_order_value purchase_frequency customer_lifetime clv loyalty_points avg_review_rating total_reviews".split()
HEATMAP = "age recency_days frequency monetary avg_order_value customer_lifetime clv loyalty_points avg_review_rating churned".split()
check("corr_with_churn", union([f"SELECT '{c}' AS feature, {correlation(c, 'churned')} AS correlation_with_churn FROM feat" for c in NUMERIC]))
check("corr_matrix", union([
    f"SELECT '{b}' AS feature_a, '{a}' AS feature_b, {correlation(a, b)} AS correlation FROM feat"
    for i, a in enumerate(HEATMAP) for b in HEATMAP[i + 1:]
]))
STEPS["welch"] = """
SELECT *, (ma - mb) / sqrt(va / na + vb / nb) AS t,
       (va / na + vb / nb) ** 2 / ((va / na) ** 2 / (na - 1) + (vb / nb) ** 2 / (nb - 1)) AS v
FROM (SELECT count(monetary) AS na, avg(monetary) AS ma, var_samp(monetary) AS va FROM feat WHERE churned = 1),
     (SELECT count(monetary) AS nb, avg(monetary) AS mb, var_samp(monetary) AS vb FROM feat WHERE churned = 0)
"""
# The p-value by Simpson's rule over the density, from 0 to |t|.
STEPS["welch_p"] = """
SELECT any_value(v) AS v, 1 - 2 * exp(any_value(lgamma((v + 1) / 2) - lgamma(v / 2))) / sqrt(any_value(v) * pi())
       * sum((CASE WHEN i IN (0, 20000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * (1 + (t * i / 20000) ** 2 / v) ** (-(v + 1) / 2))
       * any_value(abs(t)) / 60000 AS p
FROM welch, range(0, 20001) AS r(i)
"""
check("welch_t", f"""
SELECT {even("t", 4)} AS t_statistic, {even("welch.v", 4)} AS degrees_of_freedom, {even("p", 6)} AS p_value, p < 0.05 AS significant,
       {even("ma", 2)} AS churned_mean, {even("mb", 2)} AS retained_mean, na AS churned_n, nb AS retained_n FROM welch JOIN welch_p ON TRUE""")

# Churn model ----------------------------------------------------------------------------

_codes = ", ".join(
    f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS INT) AS {c}"
    for c in ("gender", "customer_segment", "favourite_category", "preferred_channel")
)
check("label_encode", f"SELECT customer_id, {_codes} FROM feat")
check("model_inputs", f"SELECT customer_id, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in NUMERIC)}, {_codes}, churned FROM feat")
check("stratified_split", """
SELECT customer_id, churned, (customer_id * 7919) % 10007 <= cut AS is_test
FROM feat JOIN (SELECT churned, quantile_cont(CAST((customer_id * 7919) % 10007 AS DOUBLE), 0.2) AS cut FROM feat GROUP BY 1) USING (churned)""")
check("class_weights", f"""
SELECT churned, count(*) AS customers, {even("(SELECT count(*) FROM feat) / ((SELECT count(DISTINCT churned) FROM feat) * count(*))", 6)} AS weight
FROM feat GROUP BY 1""")
check("classification_metrics", f"""
SELECT {even("avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END)", 4)} AS accuracy,
       {even("coalesce(sum(label * prediction) / nullif(sum(prediction), 0), 0)", 4)} AS precision,
       {even("coalesce(sum(label * prediction) / nullif(sum(label), 0), 0)", 4)} AS recall,
       {even("coalesce(2 * sum(label * prediction) / nullif(sum(prediction) + sum(label), 0), 0)", 4)} AS f1 FROM pred""")
STEPS["ranked"] = """
SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS r FROM pred
"""
check("roc_auc", f"""
SELECT {even("(rs - p * (p + 1) / 2) / (p * n)", 4)} AS roc_auc
FROM (SELECT sum(r) FILTER (WHERE label = 1) AS rs, CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS p,
             CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE) AS n FROM ranked)""")
check("confusion_matrix", """
SELECT label, prediction, count(c.label2) AS customers
FROM (SELECT unnest([0, 0, 1, 1]) AS label, unnest([0, 1, 0, 1]) AS prediction)
LEFT JOIN (SELECT label AS label2, prediction AS prediction2 FROM pred) c ON label = label2 AND prediction = prediction2
GROUP BY 1, 2""")
