from retain.llm import chat

TURNS = "conv_id long, turn long, role string, text string, key string, i int, n_turns int"


def turns(spark, convs):
    table = [(c, k, role, text, "k", 1, 2) for c, said in convs for k, (role, text) in enumerate(said)]
    return spark.createDataFrame(table, TURNS)


def test_snapshots_collapse(spark):
    a, b, c, d = ("user", "hi"), ("bot", "yes?"), ("user", "bye"), ("user", None)
    convs = [(1, [a]), (2, [a, b]), (3, [a, b, c]), (9, [a, b, c]), (4, [a, b, d]), (5, [b, a]), (6, [d]), (7, [("user", "")]), (None, [c, c])]
    out = sorted(((r["conv_id"], r["n_turns"], r["copies"]) for r in chat.collapse(turns(spark, convs)).collect()), key=repr)
    assert out == sorted([(3, 3, 2), (4, 3, 1), (5, 2, 1), (6, 1, 1), (7, 1, 1), (None, 2, 1)], key=repr)


def test_rendering_and_order(spark):
    table = [(1, 2, "bot", "b", "", 0, 0), (1, 1, "user", "a", "", 0, 0), (1, 1, "user", "a", "", 0, 0), (1, None, None, None, "", 0, 0)]
    (row,) = chat.collapse(spark.createDataFrame(table, TURNS)).collect()
    assert row["rendered"] == "<|" + "|>\n<|end|>\n<|user|>\na<|end|>\n<|bot|>\nb<|end|>\n"
    assert row["n_turns"] == 3


def test_a_hot_conversation_lies_in_many_parts(spark, request):
    table = [(None, i % 7, "user", f"t{i}", "", 0, 0) for i in range(2000)] + [(c, 0, "user", f"t{c}", "", 0, 0) for c in (0, 7, 14)]
    table += [(0, 1, "\x00", None, "", 0, 0), (7, 0, None, "\x00", "", 0, 0)]
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"  # would put a table this small into one part
    was = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    request.addfinalizer(lambda: spark.conf.set(coalesce, was))
    logs = chat.Logs(spark.createDataFrame(table, TURNS))
    hot = logs.parts.filter("conv_id is null").collect()
    assert len(hot) > 1 and max(r["held"] for r in hot) < 1500 and sum(r["held"] for r in hot) == 2000
    out = {r["conv_id"]: r for r in chat.collapse(spark.createDataFrame(table, TURNS)).collect()}
    want = "".join(f"<|user|>\nt{i}<|end|>\n" for i in sorted(range(2000), key=lambda i: (i % 7, f"t{i}")))
    assert out[None]["rendered"] == want and out[None]["n_turns"] == 2000
    assert sorted(out, key=repr) == [0, 14, 7, None]


def test_only_the_texts_that_stay_are_gathered(spark):
    said = [("user", f"t{i}") for i in range(30)]
    logs = chat.Logs(turns(spark, [(i, said[: i + 1]) for i in range(30)]))
    whole, prefixes = logs.keys()
    assert whole.count() == 30 and prefixes.count() == 29
    (row,) = logs.rendered(whole.filter("conv_id = 29")).collect()
    assert row["rendered"] == "".join(f"<|user|>\nt{i}<|end|>\n" for i in range(30))


def test_long_conversation_and_empty(spark):
    said = [("user", f"t{i}") for i in range(3000)]
    out = chat.collapse(turns(spark, [(1, said), (2, said[:2999])])).collect()
    assert [r["conv_id"] for r in out] == [1]
    assert chat.collapse(turns(spark, [])).count() == 0
