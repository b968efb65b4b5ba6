"""The five tables as one value, and the readers and writers for them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retain.config import TABLES
from retain.sources.schemas import NULL_TOKENS, REQUIRED, SCHEMAS

# Position of a row in its source, used to keep the first of duplicate keys. Dropped by cleaning.
INGEST_ORDER = "ingest_ord"


@dataclass(frozen=True)
class Bundle:
    """`order_lines` holds one row per ordered product; where an order is a single line
    (the usual input) it is the orders table itself."""

    customers: DataFrame
    orders: DataFrame
    products: DataFrame
    payments: DataFrame
    reviews: DataFrame
    order_lines: DataFrame | None = None

    @property
    def lines(self) -> DataFrame:
        return self.orders if self.order_lines is None else self.order_lines

    def items(self) -> Iterator[tuple[str, DataFrame]]:
        for name in TABLES:
            yield name, getattr(self, name)

    def map(self, fn: Callable[[str, DataFrame], DataFrame]) -> Bundle:
        return replace(self, **{name: fn(name, df) for name, df in self.items()})


def nullify_tokens(col: Column) -> Column:
    """Text that stands for a missing value becomes null."""
    return F.when(~col.isin(*NULL_TOKENS), col)


# Formats of a date column, tried in order. Add day-first or month-first ones where a source has them.
DATE_FORMATS = (
    "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss[.SSSSSS]", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]", "yyyy-MM-dd HH:mm", "yyyy/MM/dd",
)


def parse_date(col: Column, formats: str | Sequence[str] = DATE_FORMATS) -> Column:
    """Text to DATE by the first format that fits, times of day cut off; null if none does."""
    formats = [formats] if isinstance(formats, str) else formats
    return F.coalesce(*[F.try_to_date(col, f) for f in formats])


def require_columns(name: str, columns: Sequence[str]) -> None:
    missing = [c for c in REQUIRED[name] if c not in columns]
    if missing:
        raise ValueError(f"{name}: missing columns {missing}")


def whole_number(text: Column) -> Column:
    """Text to INT. 35.0 is 35, as columns with gaps are often written; a fraction or a number
    beyond the type is null."""
    number = text.try_cast("double")
    return F.when(number == F.rint(number), number.try_cast("int"))


def _from_text(name: str, field: str, kind: T.DataType, formats: Sequence[str]) -> Column:
    text = nullify_tokens(F.col(field))
    if isinstance(kind, T.DateType):
        return parse_date(text, formats)
    if isinstance(kind, T.IntegerType):
        return whole_number(text)
    return text.try_cast(kind)


def _csv_text(spark: SparkSession, path: str, multiline: bool) -> DataFrame:
    return spark.read.option("header", True).option("escape", '"').option("multiLine", multiline).csv(path)


def read_csv(
    spark: SparkSession, path: str, name: str, *, multiline: bool = False, formats: Sequence[str] = DATE_FORMATS,
    infer: bool = False,
) -> DataFrame:
    """One table from headered CSV: all columns are read by name as text, then typed.

    Columns outside the schema are kept as text, or with `infer` get the narrowest type that all
    their values fit, which reads those columns once more. `multiline` allows line breaks inside quoted
    values but makes each file one task, so it is off by default. What cannot be typed is null;
    `unreadable` counts it.
    """
    raw = _csv_text(spark, path, multiline)
    require_columns(name, raw.columns)
    position = F.struct(
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id().alias("row"),
    )
    schema = SCHEMAS[name]
    table = raw.select(
        *[_from_text(name, c, schema.get(c, T.StringType()), formats).alias(c) for c in raw.columns],
        position.alias(INGEST_ORDER),
    )
    if not infer:
        return table
    from retain.sources.inference import with_inferred_types  # it needs the readers of dates and null tokens from here

    return with_inferred_types(table, [c for c in raw.columns if c not in schema], formats)


def unreadable(
    spark: SparkSession, path: str, name: str, *, multiline: bool = False, formats: Sequence[str] = DATE_FORMATS
) -> DataFrame:
    """Per typed column of a CSV table: values that are present, and those that `read_csv` makes null."""
    raw = _csv_text(spark, path, multiline)
    typed = {c: k for c, k in SCHEMAS[name].items() if c in raw.columns and not isinstance(k, T.StringType)}
    entries = []
    for c, kind in typed.items():
        present = nullify_tokens(F.col(c)).isNotNull()
        lost = present & _from_text(name, c, kind, formats).isNull()
        entries.append(F.struct(F.lit(c).alias("column_name"), F.count_if(present).alias("present"), F.count_if(lost).alias("unreadable")))
    return raw.agg(F.array(*entries).alias("e")).select(F.inline("e"))


def read_parquet(
    spark: SparkSession, path: str, name: str, *, formats: Sequence[str] = DATE_FORMATS
) -> DataFrame:
    """One table from Parquet; dates stored as timestamps become DATE, NaN becomes null."""
    raw = spark.read.parquet(path)
    require_columns(name, raw.columns)
    columns = []
    for field in raw.schema.fields:
        col = F.col(field.name)
        if isinstance(SCHEMAS[name].get(field.name), T.DateType):
            col = parse_date(col, formats) if isinstance(field.dataType, T.StringType) else col.cast("date")
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            col = F.when(~F.isnan(col), col)
        columns.append(col.alias(field.name))
    position = F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    return raw.select(*columns, position.alias(INGEST_ORDER))


def load_all(spark: SparkSession, folder: str, fmt: str = "csv", **options) -> Bundle:
    """All five tables from `<folder>/<table>.<fmt>`, each a file or a folder of files.

    `options` (`formats`, and `multiline` and `infer` for CSV) go to the reader.
    """
    reader = {"csv": read_csv, "parquet": read_parquet}[fmt]
    tables = {}
    for name in TABLES:
        path = f"{folder.rstrip('/')}/{name}.{fmt}"
        try:
            tables[name] = reader(spark, path, name, **options)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            raise FileNotFoundError(f"no {name} table at {path}") from error
    return Bundle(**tables)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> str:
    """Write a result as Parquet or headered CSV."""
    out = df.drop(INGEST_ORDER).write.mode(mode)
    if fmt == "csv":
        out = out.option("header", True).option("escape", '"')
    out.format(fmt).save(path)
    return path
