"""The pipeline, each stage against a plain version on what the stage before it wrote."""

import re

import duckdb
import pytest
import test_decontam
import test_neardup
from pyspark.sql import functions as F

import corpus_pipeline
from retain.llm.common import materialize, read
from retain.llm.queries import ORACLE

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def written(spark):
    docs, out = read(spark, SF_DIR, "documents"), []
    odd = docs.limit(3).select(
        (F.col("doc_id") + 1_000_000).alias("doc_id"), F.element_at(F.array(F.lit(None), F.lit(""), F.lit("12 -")), (F.pmod("doc_id", F.lit(3)) + 1).cast("int")).alias("text"),
        "lang", "source", "n_chars")
    docs = materialize(docs.unionByName(odd), "input")
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, docs, docs := materialize(stage(spark, docs, SF_DIR), name)))
    return {name: (before, after) for name, before, after in out}


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_language_drops_what_has_no_letter(written):
    before, after = written["language"]
    assert after.schema == before.schema
    assert sorted(pairs(after)) == sorted((i, t) for i, t in pairs(before) if t and re.search(r"[^\W\d_]", t))


def test_near_dedup_keeps_one_of_each_group(written):
    before, after = written["near_dedup"]
    kept = {i for i, _, least in test_neardup.brute(pairs(before), 80, 5) if i == least}
    assert after.schema == before.schema and {i for i, _ in pairs(after)} == kept and after.count() == len(kept)


def test_decontaminate_drops_hit_documents(spark, written):
    before, after = written["decontaminate"]
    items = [(r["item_id"], r["text"]) for r in read(spark, SF_DIR, "benchmark").collect()]
    clean = {r[0] for r in test_decontam.brute(pairs(before), items) if not r[-1]}
    assert after.schema == before.schema and {i for i, _ in pairs(after)} == clean


def test_mix_emits_the_planned_copies(written):
    before, after = written["mix"]
    con = duckdb.connect()
    con.register("documents", before.toPandas())
    plan = {r[0]: r[5] for r in con.execute(ORACLE["op3_mix_sources"]).fetchall()}
    got = {r["doc_id"]: r["count"] for r in after.groupBy("doc_id").count().collect()}
    assert after.schema == before.schema and got == {i: n for i, n in plan.items() if n}


def test_shard_places_every_row(written):
    before, after = written["shard"]
    rows = after.toPandas()
    assert sorted(rows["doc_id"]) == sorted(i for i, _ in pairs(before))
    for _, slots in rows.groupby("shard")["slot"]:
        assert sorted(slots) == list(range(len(slots)))


def test_run_and_empty_tables(spark, tmp_path):
    for name in ("documents", "benchmark"):
        read(spark, SF_DIR, name).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_dedup", "decontaminate", "mix", "shard"]
