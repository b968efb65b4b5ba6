"""Quality of predictions, from a frame with `label`, `prediction` and `score`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retain.functions.numeric import ratio, round_half_even
from retain.functions.rows import add_row
from retain.session import materialize


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    """Rows per label and prediction, all four cells."""
    cells = predictions.agg(
        *[
            F.count_if((F.col("label") == a) & (F.col("prediction") == p)).alias(f"_{a}{p}")
            for a in (0, 1)
            for p in (0, 1)
        ]
    )
    entries = [
        F.struct(F.lit(a).alias("label"), F.lit(p).alias("prediction"), F.col(f"_{a}{p}").alias("customers"))
        for a in (0, 1)
        for p in (0, 1)
    ]
    return cells.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def classification_metrics(predictions: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1; a zero denominator gives 0."""
    hit = (F.col("label") == 1) & (F.col("prediction") == 1)
    n = predictions.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("label") == F.col("prediction")).alias("right"),
        F.count_if(hit).alias("tp"),
        F.count_if(F.col("prediction") == 1).alias("called"),
        F.count_if(F.col("label") == 1).alias("actual"),
    )

    def share(num, den, name):
        return round_half_even(F.coalesce(ratio(num, den), F.lit(0.0)), 4).alias(name)

    return n.select(
        share(F.col("right"), F.col("n"), "accuracy"),
        share(F.col("tp"), F.col("called"), "precision"),
        share(F.col("tp"), F.col("actual"), "recall"),
        share(2 * F.col("tp"), F.col("called") + F.col("actual"), "f1"),
    )


def roc_auc(predictions: DataFrame, cells: int = 256) -> DataFrame:
    """Area under the ROC curve: the chance that a positive outscores a negative, ties half.

    Scores are counted per value first, so ties are one row. The distinct scores are then dealt
    to `cells` ranges of about equal numbers, wherever scores crowd, and written once with their
    range. The negatives below a score are those of earlier ranges plus a running total inside
    its own, so no window spans all scores and no score is rounded.
    """
    per_score = predictions.groupBy("score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )
    ranged = per_score.repartitionByRange(cells, "score").withColumn("cell", F.spark_partition_id())
    placed = materialize(ranged, "scores")

    def before(window) -> Column:
        return F.coalesce(F.sum("neg").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    # At most `cells` rows.
    below = placed.groupBy("cell").agg(F.sum("neg").alias("neg")).select("cell", before(Window.orderBy("cell")).alias("below_cell"))
    ranked = placed.join(F.broadcast(below), "cell").withColumn(
        "below", F.col("below_cell") + before(Window.partitionBy("cell").orderBy("score"))
    )
    wins = (F.col("pos") * (F.col("below") + F.col("neg") / 2)).cast("decimal(28,1)")
    totals = ranked.agg(
        F.sum(wins).alias("wins"), F.sum("pos").alias("positives"), F.sum("neg").alias("negatives")
    )
    pairs = F.col("positives").cast("double") * F.col("negatives")
    return totals.select(round_half_even(ratio(F.col("wins"), pairs), 4).alias("roc_auc"))


def evaluate_model(predictions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row with the five metrics, and the confusion matrix."""
    metrics = add_row(classification_metrics(predictions), roc_auc(predictions))
    return metrics, confusion_matrix(predictions)
