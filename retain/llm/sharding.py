"""Sharding by a k-d tree over document metadata.

The rows start as one cell. A cell that stands for k shards is cut along its widest metadata
dimension (widths relative to the whole table) at the weighted median, or at the fraction that
its two halves' shard counts ask for, until each cell is one shard of about the target bytes.
A text dimension counts by the rank of its value among the distinct values. Rows with equal
coordinates are told apart by a hash of id and text, equal rows by their number, so a cut falls
where the bytes say even inside one huge value.

A median is found by counting: bytes per cell and digit of the key, ten bits at a time, all
cells of a level together. What reaches the driver is one row per cell; the rows' cells are
written once per level.

Defined cases: a null text has size 1 (no bytes plus 1); null metadata sorts first; rows that
repeat an id and text are separate rows and may lie in different shards; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from retain.llm.common import attach, cell_offsets, materialize

BITS = 20  # of a coordinate, of the hash behind it, and of the row's hash behind that
DIGIT = 10
SUB_CELLS = 1024
RUN_ROWS = 10_000


def byte_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(1)).cast("long")


def metadata(docs: DataFrame) -> dict[str, Column]:
    """The default dimensions: length (by its logarithm), source and language."""
    return {"length": F.log2(byte_size(F.col("text"))), "source": F.col("source"), "lang": F.col("lang")}


def ranked(rows: DataFrame, column: str) -> DataFrame:
    """`rows` with the text `column` replaced by its value's rank among the distinct values, from 0.

    Values are dealt out by ranges; ranks are places inside a range behind the earlier ranges' counts.
    """
    keyed = rows.withColumn("value", F.coalesce(F.concat(F.lit("="), column), F.lit("")))
    values = keyed.filter(F.col(column).isNotNull()).groupBy("value").agg(F.count(F.lit(1)).alias("copies"))
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(values.repartitionByRange(ranges, "value").withColumn("range", F.spark_partition_id()), "values")
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    before = dealt.groupBy("range").agg(F.count(F.lit(1)).alias("held")).withColumn("before", F.coalesce(F.sum("held").over(earlier), F.lit(0)))
    place = F.row_number().over(Window.partitionBy("range").orderBy("value")) - 1
    ranks = dealt.withColumn("place", place).join(before, "range").select("value", "copies", (F.col("before") + F.col("place")).cast("double").alias("rank"))
    return attach(keyed, ranks, "value", "copies", F.col("row")).drop("value", "copies", column).withColumnRenamed("rank", column)


def slim_rows(docs: DataFrame, dims: dict[str, Column]) -> DataFrame:
    """doc_id, size, text_crc32, the row's number, and the dimensions as numbers d0, d1, ..."""
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    slim = materialize(docs.select(
        "doc_id", byte_size(F.col("text")).alias("size"), crc.alias("text_crc32"), F.monotonically_increasing_id().alias("row"),
        *[d.alias(f"d{i}") for i, d in enumerate(dims.values())],
    ), "slim")
    for i in range(len(dims)):
        if isinstance(slim.schema[f"d{i}"].dataType, StringType):
            slim = ranked(slim, f"d{i}")
        else:
            slim = slim.withColumn(f"d{i}", F.col(f"d{i}").cast("double"))
    return slim


def coordinates(rows: DataFrame, n_dims: int) -> DataFrame:
    """doc_id, size, text_crc32, cell 0, tie and `at`: whole numbers from 1 to 2^20 - 1 scaled over the
    table, or 0 for null."""
    ends = rows.agg(*[f(f"d{i}").alias(f"{n}{i}") for i in range(n_dims) for f, n in ((F.min, "lo"), (F.max, "hi"))]).first()
    top = float((1 << BITS) - 2)
    scaled = []
    for i in range(n_dims):
        d, lo, hi = F.col(f"d{i}"), ends[f"lo{i}"], ends[f"hi{i}"]
        width = (hi - lo) if lo is not None and hi > lo else 1.0
        value = F.floor((d - F.lit(lo or 0.0)) / F.lit(width) * F.lit(top)).cast("long") + 1
        scaled.append(F.when(d.isNull(), F.lit(0).cast("long")).otherwise(value))
    part = lambda *cols: F.pmod(F.xxhash64(*cols), F.lit(1 << BITS))
    tie = part("doc_id", "text_crc32") * F.lit(1 << BITS) + part("row")
    return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("cell"), F.array(*scaled).alias("at"), tie.alias("tie"))


def widest(placed: DataFrame, parts: dict[int, int], n_dims: int) -> dict[int, tuple[int, int]]:
    """Of each cell that is still to be cut: its widest dimension and its bytes."""
    at = [F.element_at("at", i + 1) for i in range(n_dims)]
    cells = placed.sparkSession.createDataFrame([(c,) for c, k in parts.items() if k > 1], "cell int")
    spans = placed.join(F.broadcast(cells), "cell").groupBy("cell").agg(
        F.array(*[F.max(d) - F.min(d) for d in at]).alias("spans"), F.sum("size").alias("bytes")
    )
    return {r["cell"]: (max(range(n_dims), key=lambda i: (r["spans"][i], -i)), r["bytes"]) for r in spans.collect()}


def key_along(n_dims: int) -> Column:
    return F.element_at("at", F.col("dim") + 1) * F.lit(1 << 2 * BITS) + F.col("tie")


def cuts(placed: DataFrame, parts: dict[int, int], n_dims: int, tolerance: float) -> list[tuple[int, int, int, int]]:
    """(cell, dimension, key of the cut, shards on the left) for every cell with more than one shard."""
    spark = placed.sparkSession
    found = widest(placed, parts, n_dims)
    goal = {c: total * ((parts[c] // 2) / parts[c]) for c, (_, total) in found.items()}
    open_ = {c: (0, 0) for c in found}  # cell: key prefix so far, bytes before it
    done: dict[int, int] = {}
    for shift in range(3 * BITS - DIGIT, -1, -DIGIT):
        if not open_:
            break
        level = spark.createDataFrame(
            [(c, found[c][0], p, b, float(goal[c])) for c, (p, b) in open_.items()],
            "cell int, dim int, prefix long, base long, goal double",
        )
        inside = placed.join(F.broadcast(level), "cell").withColumn("digit", F.shiftright(key_along(n_dims), shift))
        inside = inside.filter(F.shiftright("digit", DIGIT) == F.col("prefix"))
        per = inside.groupBy("cell", "base", "goal", "digit").agg(F.sum("size").alias("bytes"))
        upto = F.col("base") + F.sum("bytes").over(Window.partitionBy("cell").orderBy("digit"))
        crossing = (
            per.withColumn("upto", upto).filter("upto >= goal")
            .groupBy("cell").agg(F.min(F.struct("digit", "upto", "bytes")).alias("at"))
        )
        for r in crossing.collect():
            c, digit, after, held = r["cell"], r["at"]["digit"], r["at"]["upto"], r["at"]["bytes"]
            if shift and held > tolerance * found[c][1]:
                open_[c] = (digit, after - held)
                continue
            nearer = digit + 1 if after - goal[c] <= goal[c] - (after - held) else digit
            done[c] = nearer << shift
            del open_[c]
    return [(c, found[c][0], done[c], parts[c] // 2) for c in sorted(done)]


def place(rows: DataFrame, level: list[tuple[int, int, int, int]], n_dims: int) -> DataFrame:
    """Move the rows right of each cut to the cell that begins with the right half's first shard."""
    table = rows.sparkSession.createDataFrame(level, "cell int, dim int, cut long, left int")
    right = F.when(key_along(n_dims) >= F.col("cut"), F.col("left")).otherwise(F.lit(0))
    moved = rows.join(F.broadcast(table), "cell", "left")
    return moved.withColumn("cell", F.col("cell") + F.coalesce(right, F.lit(0))).drop("dim", "cut", "left")


def shard(
    docs: DataFrame, *, n_shards: int | None = None, target_bytes: int | None = None,
    dims: dict[str, Column] | None = None, tolerance: float = 0.0005,
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row.

    Give the number of shards, or the bytes that a shard should reach. A cell is named by its
    first shard, so the last cells are the shards. Slots count from 0 within a shard.
    """
    dims = dims or metadata(docs)
    n_dims = len(dims)
    placed = materialize(coordinates(slim_rows(docs, dims), n_dims), "cells")
    if n_shards is None:
        total = placed.agg(F.sum("size")).first()[0] or 0
        n_shards = max(1, -(-total // (target_bytes or 1 << 30)))
    parts = {0: n_shards}
    while level := cuts(placed, parts, n_dims, tolerance):
        placed = materialize(place(placed, level, n_dims), "cells")
        whole = dict(parts)
        parts = {}
        for cell, _, _, left in level:
            parts |= {cell: left, cell + left: whole[cell] - left}
    return slots(placed.withColumnRenamed("cell", "shard"))


def slots(rows: DataFrame) -> DataFrame:
    """Number each shard's rows from 0: offsets from counts per hash class, then running totals within one.

    Equal rows are counted first and share a stretch of slots, which is written out in runs, so a
    row that is repeated without end is spread over tasks.
    """
    row = ["doc_id", "text_crc32", "size"]
    classed = rows.withColumn("sub", F.pmod(F.xxhash64(*row), F.lit(SUB_CELLS)))
    counts = classed.groupBy("shard", "sub").agg(F.count(F.lit(1)).alias("n"))
    offsets = cell_offsets(counts, ["shard"], [], "sub", "n", "before").drop("n")
    distinct = classed.groupBy("shard", "sub", *row).agg(F.count(F.lit(1)).alias("n"))
    inside = Window.partitionBy("shard", "sub").orderBy(*row).rowsBetween(Window.unboundedPreceding, -1)
    placed = distinct.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(offsets, ["shard", "sub"])
    step = F.lit(RUN_ROWS).cast("long")
    cut = placed.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, step))).hint("rebalance")
    first = F.col("before") + F.col("inside")
    slot = F.explode(F.sequence(first + F.col("run"), first + F.least(F.col("run") + step, "n") - 1))
    return cut.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", slot.alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
