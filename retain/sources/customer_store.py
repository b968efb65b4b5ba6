"""Cleaned tables stored by customer: bucketed, sorted, and dated tables by month.

Written once, they serve every later join and grouping on `customer_id` without a shuffle, and
filters on dates, status and columns reach their scans. A bucket is read by one task, so customers
with more rows than an average bucket are kept out of the buckets: their rows lie apart, spread
over many files, and are grouped there with a partial aggregation first.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retain.functions.dates import month_label
from retain.functions.joins import heavy_keys
from retain.session import materialize, shared_path
from retain.sources.bundle import INGEST_ORDER, Bundle

KEY = "customer_id"
BUCKET_BYTES = 64 << 20
APART, MONTH = "is_apart", "stored_month"
# Tables with a row per customer or more, and the date their months come from.
DATED = {"customers": None, "orders": "order_date", "reviews": None, "order_lines": "order_date"}


@dataclass(frozen=True)
class CustomerStore:
    """`usual` holds the customers in buckets, `apart` those with very many rows. Together they are
    the stored tables; products and payments are the same in both. `paths` tells where tables lie."""

    usual: Bundle
    apart: Bundle
    paths: dict[str, str]

    def per_customer(self, build: Callable[[Bundle], DataFrame]) -> DataFrame:
        """`build` over both parts. It must treat each customer by itself, as features do."""
        return build(self.usual).unionByName(build(self.apart))

    def between(self, table: str, date_from: dt.date, date_to: dt.date) -> DataFrame:
        """Rows of a dated table from `date_from` to `date_to`; other months are not read."""
        like = getattr(self.usual, table)
        months = F.col(MONTH).between(f"{date_from:%Y-%m}", f"{date_to:%Y-%m}")
        days = F.col(DATED[table]).between(F.lit(date_from), F.lit(date_to))
        return _stored_files(like, self.paths[table], [APART, MONTH]).filter(months & days).select(*like.columns)


def large_customers(tables: Sequence[DataFrame], buckets: int) -> DataFrame:
    """Customers with more rows in some table than an average bucket: fewer than `buckets` a table."""
    found = [heavy_keys(df.select(KEY), [KEY], buckets)[0] for df in tables]
    return reduce(DataFrame.union, [df for df in found if df is not None], tables[0].select(KEY).limit(0)).distinct()


def bucket_number(tables: Sequence[DataFrame]) -> int:
    """Buckets of `BUCKET_BYTES` of the largest table as estimated, a task at least for each core, and no
    more than the session's shuffle partitions. Each bucket is a file a month, whatever it holds."""
    spark = tables[0].sparkSession
    size = max(int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in tables)
    wanted = max(-(-size // BUCKET_BYTES), spark.sparkContext.defaultParallelism)
    return int(min(wanted, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def store_by_customer(
    clean: Bundle, buckets: int | None = None, count_in: Bundle | None = None, tables: Sequence[str] = tuple(DATED)
) -> CustomerStore:
    """Write the named cleaned tables by customer and return them as read back, the others as they are.

    `buckets` should leave a bucket of the largest table at some 100 MB; by default they are as many as
    `bucket_number` says. `count_in` are tables to look for large customers in, such as the
    raw ones, whose keys cost no cleaning; they may name customers that cleaning drops. The tables
    are entered in the session's catalog under new names, with their files in the shared folder.
    """
    spark = clean.orders.sparkSession
    counted = count_in or clean
    kept = {name: getattr(clean, name) for name in tables if getattr(clean, name) is not None}
    sources = [getattr(counted, name) for name in kept if getattr(counted, name) is not None]
    buckets = buckets or bucket_number(list(kept.values()))
    # Fewer than `buckets` keys a table, so the list can be broadcast.
    large = materialize(large_customers(sources, buckets), "large")
    usual, apart, paths = {}, {}, {}
    for name, df in kept.items():
        usual[name], apart[name], paths[name] = _store(df.drop(INGEST_ORDER), large, buckets, name, DATED[name])
    return CustomerStore(replace(clean, **usual), replace(clean, **apart), paths)


def _store(df: DataFrame, large: DataFrame, buckets: int, name: str, date: str | None) -> tuple[DataFrame, DataFrame, str]:
    spark, path, table = df.sparkSession, shared_path(df.sparkSession, f"by-customer-{name}"), f"retain_{name}_{uuid.uuid4().hex}"
    marked = df.join(F.broadcast(large.withColumn(APART, F.lit(True))), KEY, "left").select(
        *df.columns, F.coalesce(APART, F.lit(False)).alias(APART)
    )
    parts = [APART]
    if date:
        marked, parts = marked.withColumn(MONTH, month_label(F.col(date))), [APART, MONTH]
    # A null adds nothing to the hash, so a usual row goes to the task of its bucket, which then is one file
    # a month; rows of large customers go anywhere.
    own, spread = F.when(~F.col(APART), F.col(KEY)), F.when(F.col(APART), F.xxhash64(*df.columns))
    (
        marked.repartition(buckets, own, spread).write.format("parquet").option("path", path)
        .partitionBy(*parts).bucketBy(buckets, KEY).sortBy(KEY).saveAsTable(table)
    )
    usual = spark.table(table).filter(~F.col(APART)).select(*df.columns)
    apart = _stored_files(df, path, parts).filter(APART).select(*df.columns)
    return usual, apart, path


def _stored_files(like: DataFrame, path: str, parts: Sequence[str]) -> DataFrame:
    """A stored table read by its files, so that a bucket may be several tasks."""
    kinds = {APART: "boolean", MONTH: "string"}
    schema = reduce(lambda s, p: s.add(p, kinds[p]), parts, type(like.schema)(list(like.schema.fields)))
    return like.sparkSession.read.schema(schema).parquet(path)
