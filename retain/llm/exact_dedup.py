"""Exact duplicates by a stateful stream with disk-backed keyed state.

The stream keeps one state row per digest, without expiry: the smallest id, where that row's
content lies (file and row), and the number of rows seen. State lives in RocksDB and in the
stream's checkpoint in the shared folder, so a lost executor or a stopped run resumes, and
later files only add to it. The state is then read back as a table; rows that hit a stored
digest are compared with the stored row's full bytes, so a digest collision costs work and
never a document.

Defined cases: null text counts as empty text; null ids come last and one such row stays only
if its group has no id; of rows with equal text and id one stays; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retain.llm.common import SPACE, attach, materialize, shared_path

STATE = "spark.sql.streaming.stateStore"
SETTINGS = {
    f"{STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{STATE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{STATE}.rocksdb.boundedMemoryUsage": "true",
    f"{STATE}.rocksdb.maxMemoryUsageMB": "256",
    f"{STATE}.rocksdb.writeBufferSizeMB": "8",
    f"{STATE}.rocksdb.allowFAllocate": "false",  # many small stores: do not reserve disk ahead
}


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def keyed_rows(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """(digest, id, locator, text) of a frame that reads files."""
    text = normalised(F.col("text"))
    return docs.select(
        digest(text).alias("digest"), "doc_id", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"), text.alias("text"),
    )


def first_seen() -> Column:
    return F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row"))


def run_stream(
    spark: SparkSession, path: str, checkpoint: str, digest: Callable[[Column], Column] = sha256, files_per_batch: int = 1000
) -> None:
    """Bring the keyed state in `checkpoint` up to date with the files under `path`.

    A second call with the same checkpoint reads only files that are new.
    """
    path = path.rstrip("/")
    schema = spark.read.parquet(path).schema
    glob = f"{path[:-1]}[{path[-1]}]"  # a file source takes a single file only as a pattern
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(glob)
    state = keyed_rows(stream, digest).groupBy("digest").agg(first_seen(), F.count(F.lit(1)))
    with settings(spark, SETTINGS):
        query = (
            state.writeStream.format("noop").outputMode("update").trigger(availableNow=True)
            .option("checkpointLocation", checkpoint).start()
        )
        query.awaitTermination()


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per digest: `keep` (id and locator of the row that stays) and `n`."""
    with settings(spark, SETTINGS):
        stored = spark.read.format("statestore").load(checkpoint)
        return materialize(
            stored.select("key.digest", F.col("value.min").alias("keep"), F.col("value.count").alias("n")), "digests"
        )


def deduplicate(
    spark: SparkSession, path: str, digest: Callable[[Column], Column] = sha256,
    checkpoint: str | None = None, files_per_batch: int = 1000,
) -> DataFrame:
    """One row per row of the Parquet table at `path`: doc_id, keep_id, group_size, kept, text_sha256."""
    checkpoint = checkpoint or shared_path(spark, "dedup-state")
    run_stream(spark, path, checkpoint, digest, files_per_batch)
    state = read_state(spark, checkpoint)

    rows = keyed_rows(spark.read.parquet(path), digest)
    spread = F.xxhash64("file", "row")
    staged = materialize(
        attach(rows, state, "digest", "n", spread)
        .withColumn("is_stored", (F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row")))
        .withColumn("sha256", F.when(F.lit(digest is sha256), F.col("digest")).otherwise(sha256(F.col("text"))))
        .withColumn("text", F.when(F.col("n") > 1, F.col("text"))),
        "staged",
    )
    alone = staged.filter("n = 1")
    hits = staged.filter("n > 1")
    stored = hits.filter("is_stored").select("digest", F.col("text").alias("stored_text"), F.col("n").alias("n_stored"))
    compared = attach(hits, stored, "digest", "n_stored", spread)
    collided = materialize(
        compared.filter(F.col("text") != F.col("stored_text")).select("digest").distinct(), "collided"
    )
    same = hits.join(collided, "digest", "left_anti")
    other = hits.join(collided, "digest", "left_semi").drop("keep", "n")
    exact = other.groupBy("digest", "text").agg(first_seen().alias("keep"), F.count(F.lit(1)).alias("n"))
    regrouped = other.join(exact, ["digest", "text"]).withColumn(
        "is_stored", (F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row"))
    )
    out = ["doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
           F.col("is_stored").alias("kept"), F.col("sha256").alias("text_sha256")]
    return alone.select(*out).unionByName(same.select(*out)).unionByName(regrouped.select(*out))
