"""Data-quality profile: nulls, distinct values and duplicates per column and table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retain.functions.numeric import ratio, round_half_even
from retain.sources.bundle import INGEST_ORDER, Bundle


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _data_columns(df: DataFrame) -> DataFrame:
    return df.drop(INGEST_ORDER)


def _value(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    col = F.col(column)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return col + F.lit(0.0)  # -0.0 and 0.0 are one value
    return col.cast("string") if isinstance(kind, (T.MapType, T.VariantType)) else col


# Of these types a 64-bit hash is different for different values: it is a bijection on eight bytes.
NARROW = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def _cell(df: DataFrame, column: str) -> Column:
    """A value as two numbers; wide values have 128 bits of hash, so they never travel as text."""
    kind, value = df.schema[column].dataType, _value(df, column)
    narrow = isinstance(kind, NARROW) and not isinstance(kind, T.DecimalType)
    second = F.lit(0).cast("long") if narrow else F.xxhash64(F.lit(1), value)
    return F.struct(value.isNull().alias("absent"), F.xxhash64(value).alias("h1"), second.alias("h2"))


def table_summary(bundle: Bundle) -> DataFrame:
    """Row and column count per table."""
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("rows")).select(
                F.initcap(F.lit(name)).alias("table_name"),
                "rows",
                F.lit(len(_data_columns(df).columns)).alias("columns"),
            )
            for name, df in bundle.items()
        ]
    )


def null_counts(bundle: Bundle) -> DataFrame:
    """Nulls per column, one pass over each table."""

    def of_table(name: str, df: DataFrame) -> DataFrame:
        names = _data_columns(df).columns
        counted = df.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(F.col(c).isNull()).alias(c) for c in names],
        )
        entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in names]
        return counted.select("rows", F.explode(F.array(*entries)).alias("e")).select(
            F.lit(name).alias("table_name"),
            "e.column_name",
            "e.null_count",
            round_half_even(ratio(F.col("e.null_count"), F.col("rows")) * 100, 2).alias("null_pct"),
        )

    return _union([of_table(name, df) for name, df in bundle.items()])


def _value_counts(df: DataFrame) -> DataFrame:
    """(place of the column, absent, value's hashes, rows): a frequent value is one row per task before the shuffle."""
    cells = F.array(*[_cell(df, c) for c in _data_columns(df).columns])
    return (
        df.select(F.posexplode(cells).alias("place", "e"))
        .groupBy("place", "e.absent", "e.h1", "e.h2")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def column_profile(bundle: Bundle) -> DataFrame:
    """Per column: type, nulls, null percentage, distinct values and repeats of a value.

    Everything comes from one exact value count, so a table is shuffled once.
    """

    def of_table(name: str, df: DataFrame) -> DataFrame:
        columns = F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.lit(dtype).alias("dtype")) for c, dtype in _data_columns(df).dtypes
        ])
        return (
            _value_counts(df)
            .groupBy("place")
            .agg(
                F.coalesce(F.sum(F.when(F.col("absent"), F.col("n"))), F.lit(0)).alias("null_count"),
                F.count_if(~F.col("absent")).alias("unique_vals"),
                F.sum(F.col("n") - 1).alias("duplicate_values"),
                F.sum("n").alias("rows"),
            )
            .withColumn("c", F.get(columns, F.col("place")))
            .select(
                F.lit(name).alias("table_name"),
                "c.column_name",
                "c.dtype",
                "null_count",
                round_half_even(ratio(F.col("null_count"), F.col("rows")) * 100, 2).alias("null_pct"),
                "unique_vals",
                "duplicate_values",
            )
        )

    return _union([of_table(name, df) for name, df in bundle.items()])


SKETCH_LOG_K = 14


def sketch_error(log_k: int = SKETCH_LOG_K) -> float:
    """The relative standard error of a distinct count from a sketch."""
    return 1.04 / 2 ** (log_k / 2)


def distinct_sketches(df: DataFrame, part: Column | None = None, log_k: int = SKETCH_LOG_K) -> DataFrame:
    """One row per `part` (a day, or `input_file_name()`; one in all by default) with a mergeable
    distinct sketch per column.

    Kept beside a table, the sketches of new parts are added to the old ones without reading
    those again. A sketch has at most 2^log_k bytes, whatever the number of values.
    """

    def known(c: str) -> Column:
        value = _value(df, c)
        return value if isinstance(df.schema[c].dataType, (T.IntegralType, T.StringType, T.BinaryType)) else value.cast("string")

    sketches = [F.hll_sketch_agg(known(c), F.lit(log_k)).alias(c) for c in _data_columns(df).columns]
    return df.groupBy((F.lit("all") if part is None else part).alias("part")).agg(*sketches)


def merged_estimates(sketches: DataFrame) -> DataFrame:
    """(column_name, estimate) over all parts."""
    names = [c for c in sketches.columns if c != "part"]
    merged = sketches.agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in names])
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("estimate")) for c in names]
    return merged.select(F.inline(F.array(*entries)))


def distinct_estimates(bundle: Bundle) -> DataFrame:
    """Distinct values per column by sketches; the relative standard error is `sketch_error()`."""
    return _union([
        merged_estimates(distinct_sketches(df)).select(F.lit(name).alias("table_name"), "column_name", "estimate")
        for name, df in bundle.items()
    ])


def distinct_counts(bundle: Bundle) -> DataFrame:
    return column_profile(bundle).select("table_name", "column_name", "unique_vals")


def duplicates_by_column(bundle: Bundle) -> DataFrame:
    """Per column, rows whose value (null included) was seen before."""
    return column_profile(bundle).select("table_name", "column_name", "duplicate_values")


def duplicate_rows(bundle: Bundle) -> DataFrame:
    """Rows per table that repeat another row in every column."""

    def of_table(name: str, df: DataFrame) -> DataFrame:
        rows = _data_columns(df)
        return (
            rows.groupBy(*rows.columns)
            .agg((F.count(F.lit(1)) - 1).alias("repeats"))
            .agg(F.coalesce(F.sum("repeats"), F.lit(0)).alias("duplicate_rows"))
            .select(F.lit(name).alias("table_name"), "duplicate_rows")
        )

    return _union([of_table(name, df) for name, df in bundle.items()])


def data_quality_report(bundle: Bundle) -> DataFrame:
    """One row per column with the table's duplicate rows alongside."""
    # One row per table on the right.
    return (
        column_profile(bundle)
        .drop("duplicate_values")
        .join(F.broadcast(duplicate_rows(bundle)), "table_name")
    )


def quality_warnings(bundle: Bundle) -> DataFrame:
    """Rows and duplicate rows of every table, with its columns that have missing values, if any."""
    missing = null_counts(bundle).filter("null_count > 0")
    rows = _union([
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name, df in bundle.items()
    ])
    # One row per table, at most one per column.
    tables = rows.join(F.broadcast(duplicate_rows(bundle)), "table_name")
    return tables.join(F.broadcast(missing), "table_name", "left").orderBy("table_name", "column_name")
