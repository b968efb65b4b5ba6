"""Joining a fact table to a dimension when a few keys may hold most of the facts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fits_broadcast(df: DataFrame) -> bool:
    """True if the optimizer's size estimate is under the session's broadcast threshold."""
    threshold = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    estimate = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(estimate)) <= threshold


# Groups that keys are dealt into by a hash, so many that ordinary keys together rarely look like a heavy one.
KEY_GROUPS = 16384


def heavy_keys(df: DataFrame, keys: Sequence[str], parts: int) -> tuple[DataFrame | None, bool]:
    """The keys with more than 1/`parts` of the rows of `df`, and whether rows with a null key pass that mark.

    A key that passes lies in a group of keys that passes too, so the groups are counted first: a
    small number whatever the data, summed before the shuffle. Keys are counted only in groups that
    pass, fewer than `parts`; mostly there are none, and None is returned. Runs when called.
    """
    group = F.when(_any_null(keys), F.lit(-1)).otherwise(F.pmod(F.xxhash64(*keys), F.lit(KEY_GROUPS)).cast("int"))
    sizes = df.groupBy(group.alias("_group")).agg(F.count(F.lit(1)).alias("_n"))
    total = sizes.agg(F.sum("_n").alias("_total")).scalar()
    heavy = sizes.withColumn("_total", total).filter(F.col("_n") * F.lit(parts) > F.col("_total")).collect()
    groups = [r._group for r in heavy if r._group >= 0]
    nulls = len(groups) < len(heavy)
    if not groups:
        return None, nulls
    counts = df.filter(group.isin(groups)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    passed = counts.filter(F.col("_n") * F.lit(parts) > F.lit(heavy[0]._total)).select(*keys)
    rows = passed.collect()
    return (df.sparkSession.createDataFrame(rows, passed.schema) if rows else None), nulls


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    *,
    spread_by: Sequence[str] | Column,
    how: str = "left",
    salts: int = 64,
    hot_keys: int = 1000,
    count_in: DataFrame | None = None,
) -> DataFrame:
    """Join `fact` to `dim` (unique on `on`) without sending a hot key to one task.

    A dimension whose estimated size is under the broadcast threshold joins map-side. A
    larger one is shuffled; then every key with more than 1/`hot_keys` of the fact rows is
    spread over `salts` sub-keys by a hash of `spread_by`, and its one dimension row is
    repeated per sub-key. Fewer than `hot_keys` keys can pass that mark, whatever the data,
    so the list of them is safe to broadcast; it is looked for when this is called. Null keys
    match nothing and are spread too. Without such keys the join is a plain one by the key, and
    a later grouping by it needs no further shuffle.
    `spread_by` names columns that tell the facts apart, or is an integer column that does;
    it must give a row the same value when a task is repeated. `count_in` is the frame to
    count keys in: in a chain of joins the facts before the first one, which should be stored.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if fits_broadcast(dim):
        return fact.join(dim, keys, how)

    hot, nulls = heavy_keys((fact if count_in is None else count_in).select(*keys), keys, hot_keys)
    if hot is None and not (nulls and how != "inner"):
        return fact.join(dim, keys, how)
    hot = fact.select(*keys).limit(0) if hot is None else hot
    hot = hot.withColumn("_hot", F.lit(True))
    spread = spread_by if isinstance(spread_by, Column) else F.xxhash64(*spread_by)
    sub_key = F.pmod(spread, F.lit(salts)).cast("int")
    spread_fact = fact.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.when(_any_null(keys) | F.col("_hot"), sub_key).otherwise(F.lit(0))
    )
    repeated_dim = dim.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt",
        F.explode(
            F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
                F.array(F.lit(0))
            )
        ),
    )
    return spread_fact.drop("_hot").join(repeated_dim.drop("_hot"), [*keys, "_salt"], how).drop("_salt")
