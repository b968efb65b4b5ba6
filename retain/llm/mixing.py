"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, target / source size. The
documents of a source are put in a line, by size and then by a hash; document k covers the
stretch of expected copies from (k - 1) * rate to k * rate, shifted by the source's one random
offset, and is emitted once per integer in it. Because sizes ascend along the line, the words
taken miss the target by about one large document, not by a random sum.

Line positions come from counts per cell (source, size class, hash class), so no window holds
a whole source. A cell with more than 1/1000 of all rows (an id that repeats without end, or no
id) is cut further, by id and by a hash of the whole row. Rows that agree in source, size and id
stand in the order of that hash. Defined cases: a null text has size 0; null sources form one source, last in
order; sources of size 0 have target 0; rows that repeat an id are separate rows; an empty
table gives an empty result; any other column passes through, clashing names included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retain.llm.common import HOT_SHARE, SALTS, WORD, cell_offsets, fresh, materialize, unit_hash

SUB_CELLS = 1024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def size_class(size: Column) -> Column:
    """Text that orders sizes by their bit length and next three bits."""
    bits = F.bin(size)
    return F.concat(F.lpad(F.length(bits).cast("string"), 2, "0"), F.substring(bits, 1, 4))


def content_hash(docs: DataFrame) -> Column:
    """A hash of a row's columns, but for maps, which have no hash."""
    names = [f.name for f in docs.schema.fields if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    return F.xxhash64(*[F.col(f"`{n}`") for n in names])


def targets(sources: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """`sources` (source, source_size) plus `target`: shares by weight, filled up to the cap.

    Sources reach their cap in the order of cap / weight. With the first k of them full, the
    level of the rest is (budget - their caps) / remaining weight; it rises while full sources
    are taken out and falls afterwards, so the final level is its maximum.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sources.withColumn("weight", weight).withColumn("full", F.col("source_size") * F.lit(float(cap)))
    by_level = Window.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = F.coalesce(F.sum("full").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy()).cast("double")
    levels = ranked.withColumn("level", (total * F.lit(float(share)) - earlier) / rest)
    top = F.max("level").over(Window.partitionBy())
    return levels.withColumn("target", F.least(F.col("full"), top * F.col("weight"))).select("source", "source_size", "target")


def mix(
    docs: DataFrame, size: Column, *, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: str = "mix"
) -> DataFrame:
    """`docs` (with `doc_id` and `source`) plus a struct column of size, source_size, target, copies, taken.

    The struct is called `mix`, or another name if `docs` has a `mix` already; it comes last.
    """
    row = F.struct("*")
    line = F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string")).cast("binary"))
    keyed = docs.select(
        row.alias("row"), F.col("source"), F.col("doc_id"), size.alias("size"), line.alias("line"), content_hash(docs).alias("tie"),
    ).withColumns({
        "key": F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source"))),
        "class": size_class(F.col("size")),
        "sub": F.pmod(F.conv(F.substring("line", 1, 4), 16, 10).cast("int"), F.lit(SUB_CELLS)),
    })
    cell = ["key", "class", "sub"]
    cells = materialize(
        keyed.groupBy(*cell).agg(F.first("source").alias("source"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")),
        "cells",
    )
    per_source = cells.groupBy("key").agg(F.first("source").alias("source"), F.sum("words").alias("source_size"))
    goal = targets(per_source.drop("key"), weights, share, cap).withColumn(
        "key", F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source")))
    ).drop("source")
    offsets = cell_offsets(cells.select(*cell, "n"), ["key"], ["class"], "sub", "n", "before")
    total = cells.agg(F.sum("n").alias("rows"))
    hot = cells.filter(F.col("n") * F.lit(HOT_SHARE) > total.scalar()).select(*cell, F.lit(True).alias("hot"))
    keyed = keyed.join(F.broadcast(hot), cell, "left").withColumns({  # fewer than 1000 rows, whatever the data
        "stretch": F.when(F.col("hot"), F.col("line")).otherwise(F.lit("")),
        "part": F.when(F.col("hot"), F.pmod("tie", F.lit(SALTS)).cast("int")).otherwise(F.lit(0)),
    })
    parts = keyed.filter("hot").groupBy(*cell, "stretch", "part").agg(F.count(F.lit(1)).alias("m"))
    inside = cell_offsets(parts, cell, ["stretch"], "part", "m", "inside").drop("m")
    whole = offsets.join(goal, "key").drop("n").join(inside, cell, "left")
    plan = materialize(whole.withColumns({
        "stretch": F.coalesce("stretch", F.lit("")), "part": F.coalesce("part", F.lit(0)),
        "before": F.col("before") + F.coalesce("inside", F.lit(0)),
    }).drop("inside"), "plan")

    cut = [*cell, "stretch", "part"]
    place = F.col("before") + F.row_number().over(Window.partitionBy(*cut).orderBy("line", "doc_id", "size", "tie"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = unit_hash(F.lit(seed), F.col("key"))
    copies = F.floor(F.col("place") * F.col("rate") + F.col("offset")) - F.floor((F.col("place") - 1) * F.col("rate") + F.col("offset"))
    ranked = (
        keyed.drop("source", "hot").join(plan, cut).withColumns({"place": place, "rate": rate, "offset": offset})
        .withColumn("copies", copies.cast("long"))
    )
    out = F.struct("size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    return ranked.select("row.*", out.alias(fresh(docs, "mix")))


def emit(mixed: DataFrame) -> DataFrame:
    """The mixed corpus: each document as often as `mix` says, without the struct."""
    plan = mixed.columns[-1]
    repeated = mixed.filter(F.col(f"{plan}.copies") > 0).withColumn(
        plan, F.explode(F.sequence(F.lit(1), F.col(f"{plan}.copies").cast("int")))
    )
    return repeated.drop(plan)
