"""Canonical schemas of the five tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _D, _DATE, _B = (
    T.StringType(), T.IntegerType(), T.DoubleType(), T.DateType(), T.BooleanType(),
)

# Column names and order of the five tables.
SCHEMAS: dict[str, dict[str, T.DataType]] = {
    "customers": {
        "customer_id": _S, "first_name": _S, "last_name": _S, "email": _S, "phone": _S,
        "city": _S, "state": _S, "country": _S, "registration_date": _DATE, "age": _I,
        "gender": _S, "customer_segment": _S, "loyalty_points": _I, "is_email_verified": _B,
    },
    "orders": {
        "order_id": _S, "customer_id": _S, "product_id": _S, "order_date": _DATE,
        "quantity": _I, "unit_price": _D, "discount": _D, "subtotal": _D, "shipping_cost": _D,
        "total_amount": _D, "order_status": _S, "delivery_days": _S, "channel": _S,
    },
    "products": {
        "product_id": _S, "product_name": _S, "category": _S, "sub_category": _S, "price": _D,
        "cost": _D, "stock_qty": _I, "supplier": _S, "rating": _D, "review_count": _I,
    },
    "payments": {
        "payment_id": _S, "order_id": _S, "customer_id": _S, "payment_date": _DATE,
        "amount": _D, "payment_method": _S, "payment_status": _S, "transaction_id": _S,
    },
    "reviews": {
        "review_id": _S, "order_id": _S, "customer_id": _S, "product_id": _S, "rating": _I,
        "review_text": _S, "review_date": _DATE, "helpful_votes": _I,
    },
}

# Columns a table must have to be accepted.
REQUIRED: dict[str, tuple[str, ...]] = {
    "customers": (
        "customer_id", "registration_date", "age", "gender", "city", "state",
        "customer_segment", "loyalty_points",
    ),
    "orders": (
        "order_id", "customer_id", "product_id", "order_date", "quantity", "unit_price",
        "discount", "total_amount", "order_status", "channel",
    ),
    "products": ("product_id", "product_name", "category", "price", "cost", "rating"),
    "payments": (
        "payment_id", "order_id", "customer_id", "payment_date", "amount", "payment_method",
        "payment_status",
    ),
    "reviews": (
        "review_id", "order_id", "customer_id", "product_id", "rating", "review_date",
    ),
}

# Texts that a CSV reader takes for a missing value.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
