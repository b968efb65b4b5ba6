"""Landing CSV tables as Parquet, and writes that count what passes through them.

Counts are observed by the tasks of the write itself, so nothing is read twice. Spark adds a
write task's counts once, however often the task was tried.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retain.session import shared_path
from retain.sources.bundle import (
    DATE_FORMATS, INGEST_ORDER, Bundle, _csv_text, _from_text, nullify_tokens, require_columns,
)
from retain.config import TABLES
from retain.sources.schemas import SCHEMAS

COUNTS = "table_name string, column_name string, present long, unreadable long"


def write_counted(df: DataFrame, path: str, *metrics: Column, keep: Sequence[str] | None = None) -> dict[str, object]:
    """Write `df` as Parquet and return the metrics, named aggregates over its rows.

    Columns that only metrics need are left out of the file by listing those to `keep`.
    """
    seen = Observation()
    df.observe(seen, *metrics).select(*(keep or df.columns)).write.parquet(path)
    return seen.get


@dataclass(frozen=True)
class Landed:
    """The tables, their numbers of rows, and per typed column how many values were present and how
    many of them could not be read (`COUNTS`)."""

    bundle: Bundle
    rows: dict[str, int]
    columns: DataFrame


def land_csv(
    spark: SparkSession, path: str, name: str, *, multiline: bool = False, formats: Sequence[str] = DATE_FORMATS,
    target: str | None = None,
) -> tuple[DataFrame, int, dict[str, tuple[int, int]]]:
    """One CSV table typed and written as Parquet in one pass: the table, its rows, and per typed
    column the values present and those unreadable.

    The source position of each row is stored with it, so `keep_first` decides on keys and places.
    """
    raw = _csv_text(spark, path, multiline)
    require_columns(name, raw.columns)
    schema = SCHEMAS[name]
    typed = [c for c in raw.columns if not isinstance(schema.get(c, T.StringType()), T.StringType)]
    position = F.struct(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("row_index"),
    )
    table = raw.select(
        *[_from_text(name, c, schema.get(c, T.StringType()), formats).alias(c) for c in raw.columns],
        position.alias(INGEST_ORDER),
        *[nullify_tokens(F.col(c)).isNotNull().alias(f"_present_{i}") for i, c in enumerate(typed)],
    )
    metrics = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(typed):
        present = F.col(f"_present_{i}")
        metrics += [F.count_if(present).alias(f"p{i}"), F.count_if(present & F.col(c).isNull()).alias(f"u{i}")]
    target = target or shared_path(spark, f"landed-{name}")
    keep = [*raw.columns, INGEST_ORDER]
    seen = write_counted(table, target, *metrics, keep=keep)
    landed = spark.read.schema(table.select(*keep).schema).parquet(target)
    return landed, seen["rows"], {c: (seen[f"p{i}"], seen[f"u{i}"]) for i, c in enumerate(typed)}


def land_all(spark: SparkSession, folder: str, **options) -> Landed:
    """All five tables from `<folder>/<table>.csv`, landed with their counts."""
    tables, rows, counts = {}, {}, []
    for name in TABLES:
        tables[name], rows[name], columns = land_csv(spark, f"{folder.rstrip('/')}/{name}.csv", name, **options)
        counts += [(name, c, *n) for c, n in columns.items()]
    return Landed(Bundle(**tables), rows, spark.createDataFrame(counts, COUNTS))
