"""Duplicate removal, imputation, range limits and outlier capping."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retain.config import DEFAULT, Config
from retain.functions.numeric import clip
from retain.functions.quantiles import exact_quantiles
from retain.functions.rows import with_row
from retain.session import materialize, shared_path
from retain.sources.bundle import INGEST_ORDER, Bundle
from retain.sources.landing import write_counted


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Rows equal in every column, nulls included, are kept once."""
    return df.dropDuplicates()


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first in source order (`ingest_ord`) or in `order_by`.

    All other columns break ties, so the kept row does not depend on partitioning. This is
    an aggregation, not a window: each task keeps one row per key before the shuffle, so a
    key with very many copies reaches its final task as one row per task. It also removes
    exact duplicates, since these share their key.

    Where the source order is a row's place in its Parquet file, as `read_parquet` gives it, no
    two rows tie. Then keys and places alone decide, and the rows are fetched by their places.
    """
    keys = list(keys)
    if order_by is None and has_file_place(df):
        places = df.groupBy(*keys).agg(F.min(INGEST_ORDER).alias(INGEST_ORDER)).select(INGEST_ORDER)
        return df.join(places, INGEST_ORDER, "left_semi").select(*df.columns)
    rest = [c for c in df.columns if c not in keys]
    if order_by is None:
        order_by = [INGEST_ORDER] if INGEST_ORDER in df.columns else []
    order = [*order_by, *[c for c in rest if c not in order_by]]
    first = F.min(F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(first).select(
        *[F.col(c if c in keys else f"_row.{c}").alias(c) for c in df.columns]
    )


def has_file_place(df: DataFrame) -> bool:
    kind = df.schema[INGEST_ORDER].dataType if INGEST_ORDER in df.columns else None
    return isinstance(kind, T.StructType) and "row_index" in kind.names


def drop_null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a null in any of the listed columns are dropped."""
    return df.dropna(subset=[c for c in columns if c in df.columns])


def fill_constants(df: DataFrame, values: dict[str, object]) -> DataFrame:
    present = {c: v for c, v in values.items() if c in df.columns}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in present.items()})


def clip_columns(df: DataFrame, limits: dict[str, tuple]) -> DataFrame:
    """Limit each present column to its (lower, upper); either side may be None."""
    return df.withColumns(
        {c: clip(F.col(c), lo, hi) for c, (lo, hi) in limits.items() if c in df.columns}
    )


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls become the exact interpolated median of their column."""
    with_medians = with_row(df, "_medians", exact_quantiles(df, columns, [0.5]))
    return with_medians.withColumns(
        {
            c: F.coalesce(F.col(c).cast("double"), F.get(f"_medians.{c}", F.lit(0)))
            for c in columns
        }
    ).drop("_medians")


def iqr_fences(df: DataFrame, column: str, factor: float = DEFAULT.iqr_factor) -> DataFrame:
    """One row: quartiles and the fences q1 - f*iqr, q3 + f*iqr, unrounded."""
    quartiles = exact_quantiles(df, [column], [0.25, 0.75])
    q1, q3 = F.get(column, F.lit(0)), F.get(column, F.lit(1))
    spread = (q3 - q1) * factor
    return quartiles.select(
        q1.alias("q1"), q3.alias("q3"), (q1 - spread).alias("lower_fence"), (q3 + spread).alias("upper_fence")
    )


def cap_outliers(df: DataFrame, column: str, factor: float = DEFAULT.iqr_factor) -> DataFrame:
    """Values beyond the fences are set to the fence."""
    capped = clip(F.col(column), F.col("_iqr.lower_fence"), F.col("_iqr.upper_fence"))
    return (
        with_row(df, "_iqr", iqr_fences(df, column, factor)).withColumn(column, capped).drop("_iqr")
    )


def coerce_numeric(df: DataFrame, column: str) -> DataFrame:
    """Text to double; what is not a number becomes null."""
    return df.withColumn(column, F.col(column).try_cast("double"))


def clean_customers(df: DataFrame, staged: bool = False) -> DataFrame:
    """The median age is taken before rows without a registration date are dropped.

    `staged` writes the de-duplicated rows to the shared folder, so that the passes for the
    median read one column instead of grouping the rows again.
    """
    one_per_key = keep_first(df, ["customer_id"]).drop(INGEST_ORDER)
    if staged:
        one_per_key = materialize(one_per_key, "customers")
    imputed = impute_median(one_per_key, ["age"])
    return (
        clip_columns(imputed, {"age": (18, 90), "loyalty_points": (0, None)})
        .withColumn("age", F.col("age").cast("int"))
        .transform(fill_constants, {"gender": "Unknown", "phone": "N/A"})
        .transform(drop_null_rows, ["registration_date"])
    )


def clean_orders(
    df: DataFrame,
    keys: Sequence[str] = ("order_id",),
    config: Config = DEFAULT,
    staged: bool = False,
) -> DataFrame:
    """Orders, or order lines with `keys=("order_id", "line_no")`.

    `staged` writes the de-duplicated rows to the shared folder, so that the passes for the
    fences read one column instead of grouping the rows again.
    """
    one_per_key = keep_first(df, keys).drop(INGEST_ORDER)
    if staged:
        one_per_key = materialize(one_per_key, "orders")
    limited = (
        one_per_key.transform(drop_null_rows, ["order_id", "customer_id", "product_id", "order_date"])
        .transform(
            clip_columns,
            {
                "quantity": (1, None),
                "unit_price": (0.01, None),
                "discount": (0.0, 0.99),
                "total_amount": (0.0, None),
            },
        )
    )
    capped = cap_outliers(limited, "total_amount", config.iqr_factor)
    if "delivery_days" not in df.columns:
        return capped
    return coerce_numeric(capped, "delivery_days").transform(
        clip_columns, {"delivery_days": (1.0, 60.0)}
    )


def clean_products(df: DataFrame) -> DataFrame:
    limits = {"price": (0.01, None), "cost": (0.01, None), "rating": (1.0, 5.0), "stock_qty": (0, None)}
    return (
        clip_columns(keep_first(df, ["product_id"]).drop(INGEST_ORDER), limits)
        .transform(fill_constants, {"stock_qty": 0})
    )


def clean_payments(df: DataFrame) -> DataFrame:
    return (
        keep_first(df, ["payment_id"])
        .drop(INGEST_ORDER)
        .transform(drop_null_rows, ["payment_id", "order_id", "amount"])
        .transform(clip_columns, {"amount": (0.0, None)})
    )


def clean_reviews(df: DataFrame) -> DataFrame:
    return (
        keep_first(df, ["review_id"])
        .drop(INGEST_ORDER)
        .transform(drop_null_rows, ["review_id", "order_id", "customer_id"])
        .transform(clip_columns, {"rating": (1, 5)})
        .transform(fill_constants, {"review_text": "No review text"})
    )


def clean_all(bundle: Bundle, staged: bool = False) -> Bundle:
    cleaned = Bundle(
        customers=clean_customers(bundle.customers, staged),
        orders=clean_orders(bundle.orders, staged=staged),
        products=clean_products(bundle.products),
        payments=clean_payments(bundle.payments),
        reviews=clean_reviews(bundle.reviews),
    )
    if bundle.order_lines is None:
        return cleaned
    lines = clean_orders(bundle.order_lines, ("order_id", "line_no"), staged=staged)
    return replace(cleaned, order_lines=lines)


def cleaning_summary(raw: Bundle, cleaned: Bundle) -> DataFrame:
    """Rows before, after and removed, per table."""

    def counts(bundle: Bundle, column: str) -> DataFrame:
        frames = [
            df.agg(F.count(F.lit(1)).alias(column)).select(
                F.initcap(F.lit(name)).alias("table_name"), column
            )
            for name, df in bundle.items()
        ]
        return reduce(DataFrame.unionByName, frames)

    # Five rows on each side.
    return (
        counts(raw, "rows_before")
        .join(F.broadcast(counts(cleaned, "rows_after")), "table_name")
        .withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))
    )


def store_cleaned(raw: Bundle, cleaned: Bundle, rows_before: dict[str, int] | None = None) -> tuple[Bundle, DataFrame]:
    """Write the cleaned tables, and their `cleaning_summary` from what the writes counted.

    `rows_before` are rows per raw table as counted when these were landed; without them the raw
    tables are counted. The summary has five rows.
    """
    spark, stored, sizes = raw.orders.sparkSession, {}, []
    for name, df in cleaned.items():
        before = getattr(raw, name).count() if rows_before is None else rows_before[name]
        path = shared_path(spark, f"clean-{name}")
        after = write_counted(df, path, F.count(F.lit(1)).alias("rows"))["rows"]
        stored[name] = spark.read.schema(df.schema).parquet(path)
        sizes.append((name.capitalize(), before, after, before - after))
    if cleaned.order_lines is not None:
        stored["order_lines"] = materialize(cleaned.order_lines, "clean-order_lines")
    return Bundle(**stored), spark.createDataFrame(sizes, "table_name string, rows_before long, rows_after long, rows_removed long")
