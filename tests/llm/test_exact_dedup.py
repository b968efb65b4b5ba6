import hashlib
import re

from cases import EDGE
from pyspark.sql import functions as F

from retain.llm import exact_dedup


def expected(table):
    norm = [re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t in table]
    ids = {}
    for (i, _), t in zip(table, norm):
        ids.setdefault(t, []).append(i)
    return sorted(
        ((i, min((x for x in ids[t] if x is not None), default=None), len(ids[t]), hashlib.sha256(t.encode()).hexdigest())
         for (i, _), t in zip(table, norm)), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "text_sha256").collect()), key=repr)


def test_edge_cases(spark, frame, stored):
    path, _ = stored(frame(EDGE))
    out = exact_dedup.deduplicate(spark, path)
    assert got(out) == expected(EDGE)
    kept = out.filter("kept").collect()
    assert len(kept) == len({r["text_sha256"] for r in kept}) == len({hash_ for *_, hash_ in expected(EDGE)})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_colliding_digests_are_told_apart(spark, frame, stored):
    table = [(i, f"text {i % 7}") for i in range(50)]
    path, _ = stored(frame(table))
    # One digest for all texts.
    out = exact_dedup.deduplicate(spark, path, digest=lambda t: F.concat(F.lit("x"), F.substring(t, 1, 0)))
    assert got(out) == expected(table)


def test_state_goes_on_with_new_files(spark, frame, stored, tmp_path):
    first, second = [(5, "a b"), (6, "c")], [(2, "a  b"), (7, "c"), (8, "d")]
    path, _ = stored(frame(first))
    state = str(tmp_path / "state")
    exact_dedup.run_stream(spark, path, state, files_per_batch=1)
    frame(second).write.mode("append").parquet(path)
    assert got(exact_dedup.deduplicate(spark, path, checkpoint=state, files_per_batch=1)) == expected(first + second)


def test_empty_table(spark, frame, stored):
    path, _ = stored(frame([]))
    assert exact_dedup.deduplicate(spark, path).count() == 0
