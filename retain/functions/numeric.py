"""Null-safe numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Six places, 22 digits before the point, and 32 in a sum: exact for amounts that doubles hold to six places.
MONEY_TYPE = "decimal(28,6)"


def clip(col: Column, lower=None, upper=None) -> Column:
    """Limit to [lower, upper]; null stays null (`greatest`/`least` alone would skip it)."""
    out = col
    if lower is not None:
        out = F.greatest(out, F.lit(lower))
    if upper is not None:
        out = F.least(out, F.lit(upper))
    return F.when(col.isNotNull(), out)


def round_half_even(col: Column, digits: int) -> Column:
    """Scale, round to the nearest even integer, scale back: the rounding of float frames."""
    factor = float(10 ** digits)
    return F.rint(col * factor) / factor


def money(col: Column) -> Column:
    return col.cast(MONEY_TYPE)


def sum_money(col: Column) -> Column:
    """Exact sum: the same total for every partitioning and task order."""
    return F.sum(money(col)).cast("double")


def ratio(num: Column, den: Column) -> Column:
    """Division that gives null for a zero denominator (ANSI mode would raise)."""
    return F.try_divide(num.cast("double"), den.cast("double"))
