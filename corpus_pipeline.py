"""From the documents table to a sharded training corpus, one operator after the other.

1. `language`: documents whose text has no language (null, empty, without a letter) go.
2. `near_dedup`: one document of each near-duplicate group stays, that with the smallest id.
3. `decontaminate`: documents with any window of a benchmark item go.
4. `mix`: documents are repeated or left out to bring the sources to their target weights.
5. `shard`: every remaining row gets a shard and a slot; the result is the assignment.

Each stage reads what the one before it wrote. Rows pass through with all their columns; the
last stage returns doc_id, size, text_crc32, law, shard, slot and grown_shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retain.llm import decontam, langid, mixing, neardup, sharding
from retain.llm.common import materialize, read, ship

N_SHARDS = 8

#: Language inference, sketches and sampling hashes have no SQL form; tests compare stage by stage.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accept(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emit(mixing.mix(docs, mixing.word_count(F.col("text"))))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard(docs, n_shards=N_SHARDS)


STAGES = [
    ("language", language), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix), ("shard", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
