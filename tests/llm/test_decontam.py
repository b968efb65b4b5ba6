import random
import re

import duckdb
from cases import EDGE, rows
from pyspark.sql import functions as F

from retain.llm import decontam
from retain.llm.queries import ORACLE

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i : i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[k]
        out.append((doc, len(w), len(hit), len(found), decontam.items_digest(sorted(found)), bool(hit)))
    return sorted(out, key=repr)


NAMES = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_against_brute_force(spark, frame):
    draw = random.Random(3)
    text = lambda n: " ".join(draw.choice("aa b c, dé É f".split()) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([1, 2, 3, 5, 9, 10, 11, 30, 30])]
    items += [(20, items[7][1]), (21, None), (22, ""), (22, "short item")]
    docs = [(i, text(draw.randint(0, 700))) for i in range(60)] + [(99, "A " + items[8][1].upper().replace("É", "É") + " z")] + EDGE
    found = decontam.report(frame(docs), bench(spark, items))
    assert rows(found, *NAMES) == brute(docs, items)


def test_items_without_an_id_hit_like_the_sql(spark, frame):
    items = [(None, "one two three"), (None, "five six"), (7, "five six"), (8, "nine")]
    docs = [(1, "zero one two three four"), (2, "one two three five six"), (3, "nine"), (4, "five six"), (5, "ten"), (6, None)]
    con = duckdb.connect()
    for name, df in (("documents", frame(docs)), ("benchmark", bench(spark, items))):
        con.register(name, df.select(*df.columns[:2]).toArrow())
    found = decontam.report(frame(docs), bench(spark, items))
    want = con.execute(ORACLE["op9_wu_manber"]).fetchall()
    assert rows(found, *NAMES) == sorted(want, key=repr)
    assert {r[0]: r[2:4] for r in want} == {1: (3, 1), 2: (5, 2), 3: (1, 1), 4: (2, 2), 5: (0, 0), 6: (0, 0)}
    left = decontam.clean(frame(docs), bench(spark, items))
    assert sorted(r["doc_id"] for r in left.collect()) == [5, 6]


def test_blocks_change_nothing(spark, frame):
    items = [(i, " ".join(f"w{(i * 7 + k) % 40}" for k in range(15))) for i in range(30)]
    docs = [(i, " ".join(f"w{(i + k) % 40}" for k in range(100))) for i in range(10)]
    text = decontam.contamination(bench(spark, items), F.col("text"), block_bytes=100)
    many = frame(docs).select("doc_id", text.alias("m")).select("doc_id", "m.n_hit").collect()
    assert {r["doc_id"]: r["n_hit"] for r in many} == {r[0]: r[2] for r in brute(docs, items)}


def test_blocks_hold_distinct_windows_and_one_is_loaded(spark):
    items = [(i, " ".join(f"w{k}" for k in range(60))) for i in range(200)]  # copies of one item
    files = decontam.pattern_blocks(bench(spark, items), block_bytes=8000)
    held = []
    for file in files:
        held.append([len(t.patterns) for t in decontam.load(file)])
        assert list(decontam._held) == [file]
    assert len(files) > 3 and sum(sum(x) for x in held) == 51  # each window once, with all its ids
    assert {tuple(decontam.load(f)[0].items[0].as_py()) for f in files} == {tuple(sorted(str(i) for i in range(200)))}


def test_empty_tables_and_clean_rows(spark, frame):
    docs = frame(EDGE)
    assert decontam.report(docs, bench(spark, [])).filter("contaminated").count() == 0
    assert decontam.report(frame([]), bench(spark, [(1, "x")])).count() == 0
    left = decontam.clean(docs, bench(spark, [(1, "x")]))
    assert left.schema == docs.schema and left.count() == len(EDGE) - 1
