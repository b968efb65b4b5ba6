"""Month arithmetic on DATE columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(col: Column) -> Column:
    return F.trunc(col, "MM")


def month_label(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM")


def month_index(col: Column) -> Column:
    """Months since year 0, so that differences count calendar months."""
    return F.year(col) * 12 + F.month(col)
