"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retain.session import materialize, shared_path

__all__ = ["attach", "cell_offsets", "fresh", "materialize", "read", "shared_path", "ship", "small_batches", "unit_hash"]

#: ASCII white space, as the query contracts define it.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

BATCH_BYTES = "4m"
SALTS = 64
HOT_SHARE = 1000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ship(spark: SparkSession) -> None:
    """Have the session's Python workers import this package, wherever the session was started.

    As with `--py-files`, Spark copies the archive from the driver to each executor.
    """
    sc = spark.sparkContext
    if getattr(sc, "_retain_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sc.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(), "retain_package"), "zip", root, "retain"))
    sc._retain_shipped = True


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside send Arrow batches of about BATCH_BYTES, not of 10,000 whole texts.

    A batch is held by the executor and by the worker at once, outside the executor's heap.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def fresh(df: DataFrame, label: str) -> str:
    """A column name that `df` does not have."""
    taken = {c.lower() for c in df.columns}
    return label if label.lower() not in taken else f"{label}_{uuid.uuid4().hex[:8]}"


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, spread: Column, how: str = "left") -> DataFrame:
    """Join `rows` to `groups`, which has one row per `key` and the group's row count in `size`.

    A key with more than 1/1000 of all rows is spread over 64 sub-keys by `spread`. Fewer than
    1000 keys can pass that mark, whatever the data, so their list is safe to broadcast; the
    group's one row is repeated per sub-key. The key must not be null.
    """
    total = groups.agg(F.sum(size).alias("_total"))
    hot = groups.filter(F.col(size) * F.lit(HOT_SHARE) > total.scalar()).select(key, F.lit(True).alias("_hot"))
    salt = F.when(F.col("_hot"), F.pmod(spread, F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    left = rows.join(F.broadcast(hot), key, "left").withColumn("_salt", salt).drop("_hot")
    right = groups.join(F.broadcast(hot), key, "left").withColumn("_salt", F.explode(every)).drop("_hot")
    return left.join(right, [key, "_salt"], how).drop("_salt")


def unit_hash(*cols: Column) -> Column:
    """A number in [0, 1) that depends on the values alone, the same in every engine with MD5."""
    text = F.concat_ws("|", *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") / F.lit(2.0**32)


def cell_offsets(cells: DataFrame, outer: list[str], strata: list[str], sub: str, count: str, out: str) -> DataFrame:
    """`cells` plus the number of rows in earlier cells of the same `outer` group.

    Two windows over counts instead of one over rows: strata within a group, then sub-cells
    within a stratum. Both are bounded by the number of strata and of sub-cells.
    """
    inside = Window.partitionBy(*outer, *strata).orderBy(sub).rowsBetween(Window.unboundedPreceding, -1)
    ranked = cells.withColumn(out, F.coalesce(F.sum(count).over(inside), F.lit(0)))
    if not strata:
        return ranked
    before = Window.partitionBy(*outer).orderBy(*strata).rowsBetween(Window.unboundedPreceding, -1)
    per = cells.groupBy(*outer, *strata).agg(F.sum(count).alias("_n"))
    per = per.select(*outer, *strata, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return ranked.join(per, [*outer, *strata]).withColumn(out, F.col(out) + F.col("_base")).drop("_base")
