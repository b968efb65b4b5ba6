"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that the operators are written for. On a cluster they belong into spark-defaults.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # `mode` aggregates keep small per-group maps; the default of 128 groups per task
    # would send almost every task to the sort-based path.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "100000",
}


def local_session(cores: str = "8", name: str = "retain", **conf: str) -> SparkSession:
    """A local session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = {
        **RECOMMENDED,
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in `spark.checkpoint.dir`.

    Only a local session without that setting gets a folder of its own; on a cluster a
    machine-local folder would lose data with its executor, so the setting is required.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if path:
        return path
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="retain-"))
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/retain-{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once as Parquet in the shared folder and read it back.

    Used where several passes follow (quantile edges, scaling, model fits): the input is
    computed once, later passes read only the columns they need, and a lost executor costs
    a re-read instead of a recomputation.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
