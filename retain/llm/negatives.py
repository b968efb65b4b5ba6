"""Hard negatives by inner product, filtered with summaries of vector segments.

Components are scaled and floored to integers, so scores are exact. For segments of each of
`WIDTHS` components a vector has the segment's mean and its deviation (the length of what is left
without the mean). The inner product of two vectors is, segment by segment, the width times the
product of the means, plus or minus at most the product of the deviations. A search takes all pairs
of a block of rows and a block of anchors at the widest segments, drops those whose bounds rule
them out, and goes on with the rest at narrower segments, before it scores what is left.

Two searches run over all rows. The first finds each anchor's best rows of its own label: a pair
goes when its upper bound is below the k-th highest lower bound of the anchor. The second finds, for
each positive, the best rows of other labels whose scores lie in a range of the positive's: a pair
goes when its bounds miss the range, or when k rows surely in the range are surely better.

Anchors are a stated part of the rows. They are written in blocks to the shared folder, and each
task reads one block at a time, so every task has bounded memory and no row is sent twice. Each
block of rows gives k candidates per anchor; ranks over them cut them to k per task before the shuffle.

Defined cases: rows with a null label, a null vector, or a null or non-finite component take no
part; a null id is no anchor, comes last among ties and is returned as null; repeated rows are rows
of their own, so a copy of an anchor can be its positive and a repeated anchor has its results
twice; shorter vectors count as filled with zeros, so an empty one has score 0 with all; scaled
components beyond 2^24 count as 2^24; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retain.llm.blocks import get_block, put_blocks
from retain.llm.common import materialize

WIDTHS = (64, 16, 4)
LIMIT = 1 << 24
ROW_BLOCK = 1 << 14
ANCHOR_BLOCK = 1 << 10
DENSE_PAIRS = 1 << 22  # of rows and anchors that are taken together at the widest segments
SPARSE_PAIRS = 1 << 15

STORED = "row long, vec_id long, label string, q array<int>, " + ", ".join(f"mean_{w} array<double>, dev_{w} array<double>" for w in WIDTHS)
NEAREST = "anchor long, anchor_id long, row long, vec_id long, score long"
HARDEST = "anchor long, nth int, row long, vec_id long, score long"


def matrix(column: pa.ChunkedArray, dtype: type) -> np.ndarray:
    """A list column as rows, shorter ones filled with zeros."""
    lists = column.combine_chunks()
    size = lists.value_lengths().to_numpy()
    out = np.zeros((len(size), size.max(initial=0)), dtype)
    out[np.arange(out.shape[1]) < size[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def summary(q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each segment."""
    segments = -(-q.shape[1] // width)
    parts = np.zeros((len(q), segments * width))
    parts[:, : q.shape[1]] = q
    parts = parts.reshape(len(q), segments, width)
    mean = parts.mean(axis=2)
    return mean, np.sqrt(((parts - mean[:, :, None]) ** 2).sum(axis=2))


def as_lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel(), kind))


def summarised(vectors: DataFrame, scale: int) -> DataFrame:
    """The rows that take part, with integer components and the summaries of their segments."""

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            vector = table["vector"].combine_chunks()
            values = vector.flatten()
            bad = ~np.isfinite(values.to_numpy(zero_copy_only=False))  # nulls are NaN here
            bad = np.concatenate([[0], np.cumsum(bad)])
            ends = np.concatenate([[0], np.cumsum(vector.value_lengths().to_numpy())])
            table = table.filter(pa.array(bad[ends[1:]] == bad[ends[:-1]]))
            x = matrix(table["vector"], np.float64)
            q = np.clip(np.floor(x * scale), -LIMIT, LIMIT).astype(np.int32)
            columns = [table["row"], table["vec_id"], table["label"], as_lists(q, pa.int32())]
            for width in WIDTHS:
                columns += [as_lists(v, pa.float64()) for v in summary(q, width)]
            names = ["row", "vec_id", "label", "q", *(f"{k}_{w}" for w in WIDTHS for k in ("mean", "dev"))]
            yield from pa.table([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], names).to_batches()

    taken = vectors.filter("label is not null and vector is not null").select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"), F.col("vector").cast("array<double>").alias("vector"),
    )
    return taken.mapInArrow(store, STORED)


class Side:
    """The rows or the anchors of a search."""

    def __init__(self, table: pa.Table):
        self.table = table
        self.row, self.vec_id = (table[c].to_numpy() for c in ("row", "vec_id"))
        self.label = np.array(table["label"].to_pylist(), object)
        self.q = matrix(table["q"], np.float64)
        self.levels = [(matrix(table[f"mean_{w}"], np.float64) * np.sqrt(w), matrix(table[f"dev_{w}"], np.float64)) for w in WIDTHS]
        # Without nulls ids keep all bits; a null id comes after all others.
        ids = table["vec_id"]
        self.tie = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
        self.no_id = ids.is_null().to_numpy()


def products(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of the rows x[i] and y[j]; by one matrix product if many of all are wanted."""
    width = min(x.shape[1], y.shape[1])
    x, y = x[:, :width], y[:, :width]
    if 8 * len(i) > len(x) * len(y):
        return (x @ y.T)[i, j]
    out = np.empty(len(i), x.dtype)
    for at in range(0, len(i), SPARSE_PAIRS):
        part = slice(at, at + SPARSE_PAIRS)
        out[part] = np.einsum("ij,ij->i", x[i[part]], y[j[part]])
    return out


def exact(rows: Side, anchors: Side, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    x, y = rows.q, anchors.q
    if x.size and y.size and np.abs(x).max() * np.abs(y).max() * min(x.shape[1], y.shape[1]) >= 2**53:
        x, y = x.astype(np.int64), y.astype(np.int64)
    return products(x, y, i, j).astype(np.int64)


def kth_highest(group: np.ndarray, value: np.ndarray, k: int, n_groups: int) -> np.ndarray:
    """The k-th highest value of each group, minus infinity where there are fewer."""
    order = np.lexsort((-value, group))
    first = np.searchsorted(group[order], np.arange(n_groups + 1))
    out = np.full(n_groups, -np.inf)
    full = np.flatnonzero(np.diff(first) >= k)
    out[full] = value[order][first[full] + k - 1]
    return out


def best(rows: Side, i: np.ndarray, group: np.ndarray, score: np.ndarray, k: int, n_groups: int) -> np.ndarray:
    """Positions of the k best of each group: highest score, then least id, then first row."""
    near = np.flatnonzero(score >= kth_highest(group, score.astype(np.float64), k, n_groups)[group])
    near = near[np.lexsort((rows.row[i[near]], rows.tie[i[near]], rows.no_id[i[near]], -score[near], group[near]))]
    rank = np.arange(len(near)) - np.searchsorted(group[near], group[near])
    return near[rank < k]


def bounded(rows: Side, anchors: Side, i: np.ndarray, j: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that `keep(j, lower, upper)` leaves, level by level.

    Scores and their limits are whole numbers, so half of one is room enough for rounding.
    """
    for (mean_x, dev_x), (mean_y, dev_y) in zip(rows.levels, anchors.levels):
        middle, room = products(mean_x, mean_y, i, j), products(dev_x, dev_y, i, j) + 0.5
        kept = np.flatnonzero(keep(j, middle - room, middle + room))
        i, j = i[kept], j[kept]
    return i, j


def parts(rows: Side, anchors: Side, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of equal or of different labels, some millions at a time."""
    step = max(1, DENSE_PAIRS // max(1, len(rows.row)))
    for at in range(0, len(anchors.row), step):
        equal = rows.label[:, None] == anchors.label[None, at : at + step]
        i, j = np.nonzero(equal if same else ~equal)
        yield i, j + at


def nearest(rows: Side, anchors: Side, k: int) -> pa.Table:
    """The k best other rows of each anchor's label among `rows`."""
    n, found = len(anchors.row), []
    for i, j in parts(rows, anchors, same=True):
        other = rows.row[i] != anchors.row[j]
        i, j = bounded(rows, anchors, i[other], j[other], lambda j, low, high: high >= kth_highest(j, low, k, n)[j])
        score = exact(rows, anchors, i, j)
        at = best(rows, i, j, score, k, n)
        found.append((i[at], j[at], score[at]))
    i, j, score = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
    anchor, other = anchors.table.take(pa.array(j)), rows.table.take(pa.array(i))
    return pa.table([anchor["row"], anchor["vec_id"], other["row"], other["vec_id"], pa.array(score)],
                    ["anchor", "anchor_id", "row", "vec_id", "score"])


def hardest(rows: Side, anchors: Side, k: int, low: int, high: int) -> pa.Table:
    """The k best rows of other labels within each positive's range of scores, among `rows`."""
    lists = anchors.table["scores"].combine_chunks()
    has = np.arange(lists.value_lengths().to_numpy().max(initial=0)) < lists.value_lengths().to_numpy()[:, None]
    positive = matrix(anchors.table["scores"], np.int64)
    n, n_positive = positive.shape
    least, most = -(-low * positive // 100), high * positive // 100  # whole scores in the range
    least[~has], most[~has] = 1, 0
    found = []

    def keep(j: np.ndarray, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        kept = np.zeros(len(j), bool)
        for p in range(n_positive):
            a, b = least[j, p], most[j, p]
            may = (upper >= a) & (lower <= b) & (a <= b)
            sure = np.flatnonzero(may & (lower >= a) & (upper <= b))
            may &= upper >= kth_highest(j[sure], lower[sure], k, n)[j]
            kept |= may
        return kept

    for i, j in parts(rows, anchors, same=False):
        i, j = bounded(rows, anchors, i, j, keep)
        score = exact(rows, anchors, i, j)
        for p in range(n_positive):
            inside = np.flatnonzero((score >= least[j, p]) & (score <= most[j, p]))
            at = inside[best(rows, i[inside], j[inside], score[inside], k, n)]
            found.append((i[at], j[at], score[at], np.full(len(at), p)))
    i, j, score, nth = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 4
    other = rows.table.take(pa.array(i))
    return pa.table([pa.array(anchors.row[j]), pa.array(nth, pa.int32()), other["row"], other["vec_id"], pa.array(score)],
                    ["anchor", "nth", "row", "vec_id", "score"])


def search(rows: DataFrame, files: list[str], ddl: str, find) -> DataFrame:
    """`find(rows, anchors)` for each block of rows and each block of anchors."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= ROW_BLOCK:
                yield pa.Table.from_batches(held)
                held, n = [], 0
        if n:
            yield pa.Table.from_batches(held)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = list(files)
        for block in blocks(batches):
            side = Side(block)
            for file in order:
                yield from find(side, Side(get_block(file))).combine_chunks().to_batches()
            order.reverse()  # the block that is loaded comes first for the next rows

    return rows.mapInArrow(scan, ddl)


def ranked(found: DataFrame, by: list[str], k: int, label: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn(label, F.row_number().over(order)).filter(F.col(label) <= k)


def mine(
    vectors: DataFrame, *, every: int = 100, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90,
    scale: int = 256,
) -> DataFrame:
    """Hard negatives of the rows (vec_id, label, vector) whose id `every` divides.

    A negative has another label and a score of `low` to `high` per cent of the positive's.
    """
    rows = materialize(summarised(vectors, scale), "summaries")
    anchors = rows.filter(F.col("vec_id") % every == 0)
    n_blocks = -(-anchors.count() // ANCHOR_BLOCK)
    files = put_blocks(anchors, n_blocks, "row", "anchors")
    found = search(rows, files, NEAREST, lambda r, a: nearest(r, a, n_positives))
    positives = materialize(ranked(found, ["anchor"], n_positives, "nth"), "positives")
    scores = positives.groupBy(F.col("anchor").alias("row")).agg(F.sort_array(F.collect_list(F.struct("nth", "score"))).alias("s"))
    scored = anchors.join(scores.select("row", F.col("s.score").alias("scores")), "row")
    files = put_blocks(scored, n_blocks, "row", "positives")
    found = search(rows, files, HARDEST, lambda r, a: hardest(r, a, n_negatives, low, high))
    found = ranked(found.withColumn("nth", F.col("nth") + 1), ["anchor", "nth"], n_negatives, "rank")
    of = positives.select("anchor", "nth", "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return of.join(found.withColumnRenamed("score", "negative_score"), ["anchor", "nth"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", "negative_score"
    )


def report(embeddings: DataFrame) -> DataFrame:
    """The contract's rows: some labels are moved on first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(embeddings.select("vec_id", moved.alias("label"), F.col("embedding").alias("vector")))
