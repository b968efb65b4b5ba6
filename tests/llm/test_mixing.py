from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from retain.llm import mixing


def test_targets_are_filled_up_to_the_cap(spark):
    sources = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 500), (None, 0)], "source string, source_size long")
    found = {r["source"]: r["target"] for r in mixing.targets(sources, (5, 2, 1), 1.5, 2.0).collect()}
    assert found["a"] == 20 and found[None] == 0
    rest = 1.5 * 1510 - 20  # shared 2 : 1 by b and c, both under their caps
    assert found["b"] == pytest.approx(rest * 2 / 3) and found["c"] == pytest.approx(rest / 3)


def test_each_source_comes_near_its_target(spark, frame):
    table = [(i, "w " * (1 + i * i % 97), "en", f"s{i % 4 if i % 3 else 0}") for i in range(2000)]
    out = mixing.mix(frame(table), mixing.word_count(F.col("text")))
    assert out.columns[:-1] == frame([]).columns  # the plan has another name, as `mix` is taken
    plan = out.select("source", f"{out.columns[-1]}.*").collect()
    taken, goal = defaultdict(int), {}
    for r in plan:
        taken[r["source"]] += r["taken"]
        goal[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert all(abs(taken[s] - goal[s]) <= 2 * 97 for s in goal)


def test_emitted_rows_are_copies(spark, frame):
    table = [(i, "a b c", "en", None if i % 2 else "s") for i in range(40)] + [(None, None), (3, ""), (3, "")]
    docs = frame(table)
    mixed = mixing.mix(docs, mixing.word_count(F.col("text")))
    out = mixing.emit(mixed)
    assert out.schema == docs.schema
    counted = {r["doc_id"]: r["n"] for r in out.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert all(n <= (4 if d == 3 else 2) for d, n in counted.items())
    again = mixing.emit(mixing.mix(docs, mixing.word_count(F.col("text"))))
    assert sorted(map(repr, out.collect())) == sorted(map(repr, again.collect()))


def test_rows_without_ids_are_spread(spark, frame):
    """Half of the rows have no id; each is placed once, and a rerun over other partitions agrees."""
    table = [(i if i % 2 else None, "a b c" if i % 3 else f"d e {i}", "en", "s") for i in range(6000)]
    docs = frame(table)
    mixed = mixing.mix(docs, mixing.word_count(F.col("text")))
    plan = mixed.columns[-1]
    assert mixed.count() == 6000
    words = mixed.agg(F.sum(f"{plan}.taken"), F.max(f"{plan}.target")).first()
    assert abs(words[0] - words[1]) <= 6
    again = mixing.mix(docs.repartition(13), mixing.word_count(F.col("text")))
    chosen = lambda m: sorted(map(repr, m.select("doc_id", "text", f"{m.columns[-1]}.copies").collect()))
    assert chosen(mixed) == chosen(again)


def test_empty_table(spark, frame):
    assert mixing.mix(frame([]), mixing.word_count(F.col("text"))).count() == 0
