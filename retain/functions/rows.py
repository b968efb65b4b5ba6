"""Using the single row of one frame inside another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_row(df: DataFrame, name: str, other: DataFrame) -> DataFrame:
    """`df` with the one-row frame `other` as a struct column; null if it has no row.

    This is a scalar subquery: no join, and a plan that does not use the value does not
    compute it. Fields are read from the column, so that the subquery is planned once.
    """
    return df.withColumn(name, other.select(F.struct(*other.columns)).scalar())


def add_row(df: DataFrame, other: DataFrame) -> DataFrame:
    """`df` with the columns of the one-row frame `other`."""
    return with_row(df, "_row", other).select("*", "_row.*").drop("_row")
