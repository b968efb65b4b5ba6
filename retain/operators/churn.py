"""Churn model: feature preparation, split, random forest."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retain.config import CATEGORICAL_FEATURES, DEFAULT, NUMERIC_FEATURES, TARGET, Config
from retain.functions.joins import join_dimension
from retain.functions.numeric import ratio, round_half_even
from retain.functions.quantiles import exact_quantiles
from retain.functions.rows import add_row, with_row
from retain.session import materialize


def label_codes(feat: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, code): the distinct values and their positions in sorted order, from 0.

    Null counts as the text "nan". The values of all columns are dealt out by ranges, written once,
    and numbered by the rows of earlier ranges plus the position in their own; a range is about one
    part in `spark.sql.shuffle.partitions` of all values, whatever they begin with.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), _label(c).alias("value")) for c in columns])
    values = feat.select(F.explode(cells).alias("e")).select("e.*").distinct()
    ranges = int(feat.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = values.repartitionByRange(ranges, "column_name", "value").withColumn("_range", F.spark_partition_id())
    ranged = materialize(ranged, "labels")
    # At most one row per range and column.
    earlier = Window.partitionBy("column_name").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("column_name", "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("column_name", "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("column_name", "_range").orderBy("value")) - 1
    numbered = ranged.withColumn("_place", place).join(before, ["column_name", "_range"])
    return numbered.select("column_name", "value", (F.col("_before") + F.col("_place")).cast("int").alias("code"))


def _label(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("nan"))


def label_encode(feat: DataFrame, columns: tuple[str, ...] = CATEGORICAL_FEATURES) -> DataFrame:
    """Replace each category by its position among the sorted distinct values, from 0.

    The codes of all columns come from one pass; rows meet them in joins that spread a frequent category.
    """
    present = [c for c in columns if c in feat.columns]
    if not present:
        return feat
    codes, encoded = label_codes(feat, present), feat
    for c in present:
        own = codes.filter(F.col("column_name") == c).select(F.col("value").alias(c), F.col("code").alias("_code"))
        counted = feat.select(_label(c).alias(c))
        joined = join_dimension(encoded.withColumn(c, _label(c)), own, c, spread_by=["customer_id"], count_in=counted)
        encoded = joined.withColumn(c, F.col("_code")).drop("_code")
    return encoded.select(*feat.columns)


def fill_medians(feat: DataFrame, columns: tuple[str, ...] = NUMERIC_FEATURES) -> DataFrame:
    """Numeric columns as double, nulls replaced by the median."""
    present = [c for c in columns if c in feat.columns]
    numeric = feat.withColumns({c: F.col(c).cast("double") for c in present})
    with_medians = with_row(numeric, "_medians", exact_quantiles(numeric, present, [0.5]))
    return with_medians.withColumns(
        {c: F.coalesce(F.col(c), F.get(f"_medians.{c}", F.lit(0))) for c in present}
    ).drop("_medians")


def prepare_features(feat: DataFrame, exclude_leaky: bool = False) -> tuple[DataFrame, list[str]]:
    """Customer id, predictors and label.

    The label is a threshold on `recency_days`, which is also a predictor; `exclude_leaky`
    leaves it out.
    """
    wanted = [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES]
    names = [c for c in wanted if c in feat.columns and not (exclude_leaky and c == "recency_days")]
    table = feat.select("customer_id", *names, F.col(TARGET).cast("int").alias(TARGET))
    return label_encode(fill_medians(table)), names


def stratified_split(
    df: DataFrame, label: str = TARGET, key: str = "customer_id", config: Config = DEFAULT,
    draw: Column | None = None,
) -> DataFrame:
    """Adds `is_test`: per class, the share with the lowest hash of the key.

    The hash threshold is an exact quantile per class, so class shares hold to within one
    row, without sorting a class in one task. The same rows are drawn in every run. `draw` is
    another number to draw by.
    """
    number = F.xxhash64(F.lit(config.seed), F.col(key)) if draw is None else draw
    drawn = df.withColumn("_draw", number.cast("double"))
    cut = exact_quantiles(drawn, ["_draw"], [config.test_share], by=[label]).select(
        F.col(label).alias("_class"), F.get("_draw", F.lit(0)).alias("_cut")
    )
    # One row per class.
    return (
        drawn.join(F.broadcast(cut), F.col(label).eqNullSafe(F.col("_class")), "left")
        .withColumn("is_test", F.col("_draw") <= F.col("_cut"))
        .drop("_draw", "_cut", "_class")
    )


def class_weights(df: DataFrame, label: str = TARGET) -> DataFrame:
    """Balanced weights n / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("customers"))
    total = counts.agg(F.sum("customers").alias("_n"), F.count(F.lit(1)).alias("_k"))
    balanced = ratio(F.col("_n"), F.col("_k") * F.col("customers"))
    return add_row(counts, total).select(
        label, "customers", round_half_even(balanced, 6).alias("weight")
    )


@dataclass(frozen=True)
class ChurnModel:
    model: RandomForestClassificationModel
    train: DataFrame
    test: DataFrame
    predictions: DataFrame
    feature_names: list[str]


def train_churn_model(
    feat: DataFrame, config: Config = DEFAULT, exclude_leaky: bool = False
) -> ChurnModel:
    """Random forest on the training share, with predictions for the test share.

    The prepared table is written once; fitting passes over it level by level. Category
    codes are plain numbers here, so trees split them as ordered values. Spark has no
    minimum size for a split; half of it per child is the nearest setting.
    """
    table, names = prepare_features(feat, exclude_leaky)
    split = materialize(stratified_split(table, config=config), "churn")
    train, test = split.filter("not is_test"), split.filter("is_test")
    weighted = train.join(F.broadcast(class_weights(train).select(TARGET, "weight")), TARGET)
    assembler = VectorAssembler(inputCols=names, outputCol="features")
    points = assembler.transform(weighted).select("features", TARGET, "weight")
    points.persist(StorageLevel.MEMORY_AND_DISK)
    forest = RandomForestClassifier(
        labelCol=TARGET,
        weightCol="weight",
        numTrees=config.trees,
        maxDepth=config.tree_depth,
        minInstancesPerNode=max(config.min_split // 2, 1),
        featureSubsetStrategy="sqrt",
        maxBins=config.max_bins,
        maxMemoryInMB=1024,
        seed=config.seed,
    )
    try:
        model = forest.fit(points)
    finally:
        points.unpersist()
    # The summary of a fit holds the session, which need not serialize: it cannot once it has observed a write.
    # A copy has no summary, and predicts the same.
    model = model.copy()
    predictions = model.transform(assembler.transform(test)).select(
        "customer_id",
        F.col(TARGET).alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("score"),
    )
    return ChurnModel(model, train, test, predictions, names)


def feature_importance(fitted: ChurnModel, top: int | None = None) -> DataFrame:
    """Importance per predictor, highest first."""
    rows = zip(fitted.feature_names, (float(v) for v in fitted.model.featureImportances.toArray()))
    ranked = fitted.test.sparkSession.createDataFrame(
        list(rows), "feature string, importance double"
    ).orderBy(F.desc("importance"), "feature")
    return ranked if top is None else ranked.limit(top)
