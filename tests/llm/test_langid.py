import random

from cases import EDGE
from pyspark.sql import functions as F

from retain.llm import langid
from retain.llm.common import read


def test_held_out_accuracy(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    out = langid.predict(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null")
    assert out.filter("lang_pred = lang").count() >= 0.97 * out.count()


def tongue(seed, n):
    draw = random.Random(seed)
    parts = ["".join(draw.choice("abcdefghijklmnop"[seed :: 2]) for _ in range(3)) for _ in range(12)]
    draw.seed(n)
    return " ".join("".join(draw.choice(parts) for _ in range(3)) for _ in range(n))


def test_mixtures_and_edge_cases(spark, frame):
    labelled = [(i, tongue(i % 2, 60 + i), "ab"[i % 2]) for i in range(40)]
    model = langid.train(frame(labelled))
    half = tongue(0, 100) + " " + tongue(1, 101)
    table = [(100, half), (101, tongue(0, 90)), (102, "12 34 !?"), *EDGE]
    out = frame(table).select("doc_id", langid.identify(model, F.col("text")).alias("p")).select("doc_id", "p.*").collect()
    first = {r["doc_id"]: r for r in out}
    assert set(first[100]["langs"]) == {"a", "b"} and 0.4 < first[100]["score"] < 0.6
    assert (first[101]["lang"], first[101]["score"]) == ("a", 1.0)
    for i in (102, 2, 3, 4):
        assert (first[i]["lang"], first[i]["score"]) == ("und", 0.0)
    assert all(0 <= r["score"] <= 1 for r in out) and len(out) == len(table)


def test_without_labels_and_empty(spark, frame):
    assert {r["lang_pred"] for r in langid.predict(frame(EDGE)).collect()} == {"und"}
    assert langid.predict(frame([])).count() == 0


def test_accept_keeps_rows_with_letters(spark, frame):
    docs = frame([(1, "hello there", "en"), (2, "..."), (3, None), (4, "word")])
    kept = langid.accept(docs)
    assert kept.schema == docs.schema and sorted(r["doc_id"] for r in kept.collect()) == [1, 4]


def test_accept_without_labels_keeps_rows_with_letters(spark, frame):
    table = [(1, "hello there"), (2, "..."), (3, None), (4, "ü"), (5, "")]
    assert sorted(r["doc_id"] for r in langid.accept(frame(table)).collect()) == [1, 4]
    labelled = [(1, "hello there", "und"), (2, "...", "und"), (3, None, "en"), (4, "word", None)]
    assert sorted(r["doc_id"] for r in langid.accept(frame(labelled)).collect()) == [1, 4]


def test_bucket_ids_hold_out_a_quarter(spark):
    n = spark.range(4000).filter(langid.held_out(F.col("id"))).count()
    assert 800 < n < 1200
