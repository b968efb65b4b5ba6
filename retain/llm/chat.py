"""Collapsing cumulative snapshots of logged conversations, and rendering what remains.

A conversation that was logged after every turn appears many times, each log a prefix of the
next. Rolling hashes of the turns (128 bits, position by position) give every prefix a key. A
log whose whole key is another log's proper prefix is dropped by an anti-join; of equal logs the
smallest conv_id stays. Both sides are reduced to distinct keys first, so a prefix that all
conversations share is one row.

Turns are dealt to parts by ranges of their order, so a long conversation lies in many. Positions
and hashes are cumulated within a part, then over a conversation's parts. Keys are rows without
texts; only the texts of the conversations that stay are gathered and rendered.

Defined cases: a null conv_id is one conversation of its own; turns come in the order of turn,
role and text, nulls first; rows repeated exactly count once; null role and text differ from
empty ones when compared and render as empty; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retain.llm.common import materialize

TURN = "<|{role}|>\n{text}<|end|>\n"
HEAD = 256  # characters of a text by which turns are dealt; behind them one task orders equal ones


def rendered(role: Column, text: Column, template: str = TURN) -> Column:
    """One turn by the template, which names {role} and {text} once each, in this order."""
    head, _, rest = template.partition("{role}")
    middle, _, tail = rest.partition("{text}")
    empty = F.lit("")
    return F.concat(F.lit(head), F.coalesce(role, empty), F.lit(middle), F.coalesce(text, empty), F.lit(tail))


class Logs:
    """The tables of one run.

    `turns` are the distinct turns in order: `pos` grows with the order, within one part (of
    bounded rows) without gaps. `parts` has one row per conversation and part that it lies in.
    """

    def __init__(self, turns: DataFrame):
        said = turns.select("conv_id", "turn", "role", "text").distinct()
        order = ["cid", "turn", "role"]
        ordered = (
            said.withColumn("cid", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))
            .repartitionByRange(*order, F.substring("text", 1, HEAD)).sortWithinPartitions(*order, "text")
            .withColumn("pos", F.monotonically_increasing_id())
        )
        self.turns = materialize(ordered.withColumn("part", F.shiftright("pos", 33)), "turns")
        parts = self.turns.groupBy("cid", "part").agg(
            F.min("pos").alias("first"), F.count(F.lit(1)).alias("held"), F.min("conv_id").alias("conv_id")
        )
        whole = Window.partitionBy("cid")
        before = F.coalesce(F.sum("held").over(earlier()), F.lit(0)).alias("before")
        self.parts = materialize(parts.select("*", before, F.sum("held").over(whole).alias("n_turns")), "parts")

    def keys(self) -> tuple[DataFrame, DataFrame]:
        """The keys of whole conversations (cid, conv_id, key) and of their proper prefixes (key)."""
        empty = F.lit("")
        said = [c for n in ("role", "text") for c in (F.isnull(n), F.coalesce(n, empty))]
        turn = self.turns.select("cid", "part", "pos", F.xxhash64(*said).alias("x"), F.xxhash64(F.lit(1), *said).alias("y"))
        here = turn.join(self.parts, ["cid", "part"]).withColumn("i", F.col("before") + F.col("pos") - F.col("first") + 1)
        upto = Window.partitionBy("cid", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rolled = materialize(here.select(
            "cid", "part", "conv_id", "i", "n_turns", (F.col("i") == F.col("before") + F.col("held")).alias("end"),
            F.bit_xor(F.xxhash64("i", "x", "y")).over(upto).alias("a"), F.bit_xor(F.xxhash64(F.lit(1), "i", "x", "y")).over(upto).alias("b"),
        ), "rolled")
        bases = rolled.filter("end").select(
            "cid", "part", *[F.coalesce(F.bit_xor(c).over(earlier()), F.lit(0)).alias(f"base_{c}") for c in "ab"]
        )
        key = F.struct(*[F.col(c).bitwiseXOR(F.col(f"base_{c}")).alias(c) for c in "ab"], "i").alias("key")
        found = rolled.join(bases, ["cid", "part"])
        return found.filter("i = n_turns").select("cid", "conv_id", key), found.filter("i < n_turns").select(key).distinct()

    def rendered(self, kept: DataFrame, template: str = TURN) -> DataFrame:
        """(cid, rendered) of the conversations in `kept` (cid); only their texts are gathered."""
        parts = self.parts.join(kept.select("cid"), "cid", "left_semi").select("cid", "part")
        said = self.turns.join(parts, ["cid", "part"]).select(
            "cid", "part", "pos", rendered(F.col("role"), F.col("text"), template).alias("said")
        )
        return in_order(in_order(said, ["cid", "part"], "pos"), ["cid"], "part").withColumnRenamed("said", "rendered")


def earlier() -> Window:
    """The earlier parts of a conversation: a conversation has no more parts than there are partitions."""
    return Window.partitionBy("cid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)


def in_order(rows: DataFrame, by: list[str], order: str) -> DataFrame:
    """The texts `said` of each group, joined in order."""
    held = F.sort_array(F.collect_list(F.struct(order, "said")))
    return rows.groupBy(*by).agg(F.concat_ws("", F.transform(held, lambda s: s["said"])).alias("said"))


def collapse(turns: DataFrame, template: str = TURN) -> DataFrame:
    """The maximal conversations: conv_id, n_turns, copies (equal logs), rendered."""
    logs = Logs(turns)
    whole, prefixes = logs.keys()
    firsts = whole.groupBy("key").agg(
        F.min(F.struct(F.col("conv_id").isNull().alias("no_id"), "conv_id", "cid")).alias("log"), F.count(F.lit(1)).alias("copies")
    )
    maximal = firsts.join(prefixes, "key", "left_anti")
    kept = materialize(maximal.select("log.cid", "log.conv_id", F.col("key.i").cast("int").alias("n_turns"), "copies"), "maximal")
    return kept.join(logs.rendered(kept, template), "cid").select("conv_id", "n_turns", "copies", "rendered")
