"""k-means segments on log-scaled recency, frequency and monetary value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retain.config import DEFAULT, Config
from retain.functions.numeric import ratio, round_half_even
from retain.functions.quantiles import exact_quantiles
from retain.functions.rows import with_row
from retain.session import materialize

AXES = ("recency_days", "frequency", "monetary")

# Cluster names by falling median monetary value.
CLUSTER_NAMES = ("Champions", "Loyal Customers", "Potential Loyalists", "At Risk", "Lost")


def kmeans_inputs(feat: DataFrame) -> DataFrame:
    """Log-scaled axes; recency is turned round so that recent customers score high."""
    filled = feat.select(
        "customer_id", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in AXES]
    )
    longest = filled.agg(F.max("recency_days")).scalar()
    return filled.select(
        "customer_id",
        F.log1p(longest - F.col("recency_days")).alias("recency_days"),
        F.log1p("frequency").alias("frequency"),
        F.log1p("monetary").alias("monetary"),
    )


def scaling_row(inputs: DataFrame) -> DataFrame:
    return inputs.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in AXES],
        *[F.stddev_pop(c).alias(f"sd_{c}") for c in AXES],
    )


def kmeans_scaled(inputs: DataFrame) -> DataFrame:
    """Mean 0 and population standard deviation 1 per axis; a constant axis is only centred."""
    scaled = []
    for c in AXES:
        centred = F.col(c) - F.col(f"_scale.mean_{c}")
        scaled.append(F.coalesce(ratio(centred, F.col(f"_scale.sd_{c}")), centred).alias(c))
    return with_row(inputs, "_scale", scaling_row(inputs)).select("customer_id", *scaled)


def kmeans_segmentation(
    feat: DataFrame, config: Config = DEFAULT
) -> tuple[DataFrame, KMeansModel, DataFrame]:
    """Adds `kmeans_cluster` and `kmeans_segment`; also returns the model and the scaling row.

    The narrow scaled table is written once; every restart reads it from the executors'
    cache, and only the k centres come back to the driver. The restart with the lowest cost wins.
    """
    inputs = kmeans_inputs(feat)
    scaled = materialize(kmeans_scaled(inputs), "kmeans")
    points = VectorAssembler(inputCols=list(AXES), outputCol="features").transform(scaled)
    points.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fits = (
            KMeans(k=config.kmeans_k, seed=config.seed + i).fit(points)
            for i in range(config.kmeans_restarts)
        )
        model = min(fits, key=lambda m: m.summary.trainingCost)
    finally:
        points.unpersist()
    clustered = assign_clusters(feat, model, inputs)
    names = cluster_names(kmeans_profile(clustered)).select("kmeans_cluster", "kmeans_segment")
    # At most k rows.
    return clustered.join(F.broadcast(names), "kmeans_cluster", "left"), model, scaling_row(inputs)


def assign_clusters(feat: DataFrame, model: KMeansModel, inputs: DataFrame) -> DataFrame:
    """`feat` plus `kmeans_cluster`: rows are scaled and assigned where they are, without a join."""
    place = [f"_{c}" for c in AXES]
    longest = feat.agg(F.max(F.coalesce(F.col("recency_days").cast("double"), F.lit(0.0)))).scalar()
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in AXES}
    logs = {"recency_days": F.log1p(longest - filled["recency_days"]), **{c: F.log1p(filled[c]) for c in AXES[1:]}}
    scaled = {}
    for c, name in zip(AXES, place):
        centred = logs[c] - F.col(f"_scale.mean_{c}")
        scaled[name] = F.coalesce(ratio(centred, F.col(f"_scale.sd_{c}")), centred)
    placed = with_row(feat, "_scale", scaling_row(inputs)).withColumns(scaled)
    points = VectorAssembler(inputCols=place, outputCol="features").transform(placed)
    assigned = model.transform(points).withColumnRenamed("prediction", "kmeans_cluster")
    return assigned.select(*feat.columns, "kmeans_cluster")


def nearest_centre(scaled: DataFrame, centres: Sequence[Sequence[float]]) -> DataFrame:
    """`kmeans_cluster`: the position of the nearest of the given centres, the first of equal ones."""
    apart = [
        sum((F.col(c) - F.lit(float(at))) * (F.col(c) - F.lit(float(at))) for c, at in zip(AXES, centre)) for centre in centres
    ]
    distances = F.array(*apart)
    return scaled.withColumn("kmeans_cluster", (F.array_position(distances, F.array_min(distances)) - 1).cast("int"))


def kmeans_profile(clustered: DataFrame) -> DataFrame:
    """Customers and the median recency, frequency and monetary value per cluster."""
    medians = exact_quantiles(clustered, list(AXES), [0.5], by=["kmeans_cluster"]).select(
        "kmeans_cluster",
        *[round_half_even(F.get(c, F.lit(0)), 6).alias(f"median_{c}") for c in AXES],
    )
    sizes = clustered.groupBy("kmeans_cluster").agg(F.count(F.lit(1)).alias("customers"))
    return sizes.join(medians, "kmeans_cluster")


def cluster_names(profile: DataFrame) -> DataFrame:
    """Names by rank of median monetary value; clusters beyond the known names stay unnamed."""
    # One row per cluster, so the unpartitioned window holds k rows.
    rank = F.row_number().over(Window.orderBy(F.desc("median_monetary"), "kmeans_cluster"))
    names = F.array(*[F.lit(n) for n in CLUSTER_NAMES])
    return profile.withColumn("kmeans_segment", F.get(names, rank - 1))
