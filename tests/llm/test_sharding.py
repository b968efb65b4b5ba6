import zlib

from cases import EDGE
from pyspark.sql import functions as F

from retain.llm import sharding
from retain.llm.common import read


def test_shards_are_near_equal_and_slots_gapless(spark):
    out = sharding.shard(read(spark, "/root/testdata/sf0.01", "documents"), n_shards=8).toPandas()
    held = out.groupby("shard")["size"].sum()
    assert list(held.index) == list(range(8)) and held.max() <= 1.05 * held.mean()
    for _, slots in out.groupby("shard")["slot"]:
        assert sorted(slots) == list(range(len(slots)))


def test_first_cut_is_the_weighted_median_of_the_widest_dimension(spark, frame):
    docs = frame([(i, "x" * (i % 50)) for i in range(400)])
    out = sharding.shard(docs, n_shards=2, dims={"id": F.col("doc_id")}, tolerance=0.0).toPandas().sort_values("doc_id")
    left = out[out["shard"] == 0]
    assert left["doc_id"].max() < out[out["shard"] == 1]["doc_id"].min()
    assert abs(left["size"].sum() - out["size"].sum() / 2) <= out["size"].max()


def test_one_hot_value_is_cut_by_its_hash(spark, frame):
    out = sharding.shard(frame([(i, "same text") for i in range(3000)]), n_shards=8).toPandas()
    held = out.groupby("shard")["size"].sum()
    assert len(held) == 8 and held.max() <= 1.02 * held.mean()


def test_target_bytes_and_odd_counts(spark, frame):
    docs = frame([(i, "x" * 99) for i in range(600)])
    assert sharding.shard(docs, target_bytes=20_000).select("shard").distinct().count() == 3


def brute(rows, cell, parts, dims):
    """The shard of every row (at, tie, size) by cutting sorted lists."""
    if parts == 1 or not rows:
        return {r: cell for r in rows}
    spans = [max(r[0][d] for r in rows) - min(r[0][d] for r in rows) for d in range(dims)]
    dim = spans.index(max(spans))
    goal, upto, left = sum(r[2] for r in rows) * ((parts // 2) / parts), 0, []
    ordered = sorted(rows, key=lambda r: (r[0][dim], r[1]))
    for r in ordered:
        if upto + r[2] >= goal:
            left += [r] if upto + r[2] - goal <= goal - upto else []
            break
        left.append(r)
        upto += r[2]
    return brute(left, cell, parts // 2, dims) | brute(ordered[len(left):], cell + parts // 2, parts - parts // 2, dims)


def test_whole_tree_against_sorted_lists(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    coded = sharding.coordinates(sharding.slim_rows(docs, sharding.metadata(docs)), 3).collect()
    rows = [(tuple(r["at"]), r["tie"], r["size"], r["doc_id"]) for r in coded]
    want = {r[3]: c for r, c in brute(rows, 0, 7, 3).items()}
    out = sharding.shard(docs, n_shards=7, tolerance=0.0).collect()
    assert {r["doc_id"]: r["shard"] for r in out} == want and len(out) == len(want) == len(rows)


def test_values_with_a_common_head_are_cut_apart(spark, frame):
    docs = frame([(i, "same size", "en", f"common_crawl_{'ab'[i % 2]}") for i in range(2000)])
    out = sharding.shard(docs, n_shards=2).collect()
    assert {(r["doc_id"] % 2, r["shard"]) for r in out} == {(0, 0), (1, 1)}


def test_equal_rows_are_shared_out(spark, frame, monkeypatch):
    monkeypatch.setattr(sharding, "RUN_ROWS", 100)
    out = sharding.shard(frame([(None, "one text")] * 4000), n_shards=8).toPandas()
    held = out.groupby("shard")["size"].sum()
    assert len(out) == 4000 and len(held) == 8 and held.max() <= 1.02 * held.mean()
    for _, slots in out.groupby("shard")["slot"]:
        assert sorted(slots) == list(range(len(slots)))


def test_edge_cases(spark, frame):
    out = sharding.shard(frame(EDGE), n_shards=8).collect()
    assert len(out) == len(EDGE)
    for r in out:
        assert 0 <= r["shard"] < 8 and r["law"] == "bytes" and r["grown_shard"] is None
    found = sorted((r["doc_id"] or -1, r["size"], r["text_crc32"]) for r in out)
    assert found == sorted((i or -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in EDGE)
    assert sharding.shard(frame([]), n_shards=8).count() == 0
