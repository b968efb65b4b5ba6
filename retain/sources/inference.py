"""Types of text columns: the narrowest that every present value fits, found in one distributed pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retain.sources.bundle import DATE_FORMATS, nullify_tokens, parse_date

# The types, the narrowest first. Text fits everything; a column without values is text.
ORDER = ("boolean", "bigint", "double", "date")
WHOLE = r"^[+-]?[0-9]+$"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(?i:inf|infinity)$"


def typed(text: Column, kind: str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Text as a type, null where it does not fit. Suffixes that casts allow (`1d`, `2L`) do not fit."""
    bare = F.trim(text)
    if kind == "boolean":
        return F.when(F.lower(bare).isin("true", "false"), F.lower(bare) == "true")
    if kind == "bigint":
        return F.when(bare.rlike(WHOLE), bare).try_cast("bigint")
    if kind == "double":
        return F.when(bare.rlike(NUMBER), bare).try_cast("double")
    return parse_date(bare, formats) if kind == "date" else text


def type_votes(raw: DataFrame, columns: Sequence[str], formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """One row per column: present values, how many fit each type, and the type that is taken.

    Each task adds up its own votes, so one short row per task is shuffled.
    """
    if not columns:
        raise ValueError("no columns to type")
    votes = []
    for c in columns:
        text = nullify_tokens(F.col(c))
        fits = [F.count(typed(text, kind, formats)).alias(f"fits_{kind}") for kind in ORDER]
        votes.append(F.struct(F.lit(c).alias("column_name"), F.count(text).alias("present"), *fits))
    rows = raw.agg(F.array(*votes).alias("v")).select(F.inline("v"))
    chosen = F.coalesce(
        *[F.when((F.col("present") > 0) & (F.col(f"fits_{kind}") == F.col("present")), kind) for kind in ORDER], F.lit("string")
    )
    return rows.withColumn("inferred", chosen)


def with_inferred_types(raw: DataFrame, columns: Sequence[str], formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """`raw` with the text columns `columns` as the types their values fit. The driver gets one name per column."""
    if not columns:
        return raw
    kinds = {r["column_name"]: r["inferred"] for r in type_votes(raw, columns, formats).select("column_name", "inferred").collect()}
    return raw.withColumns({c: typed(nullify_tokens(F.col(c)), kind, formats) for c, kind in kinds.items()})
