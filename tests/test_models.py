import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from retain import Config
from retain.operators import churn, evaluation, kmeans, profiling, statistics

PREDICTION = "label int, prediction int, score double"


def customers(spark, n=400):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(n):
        recency = int(rng.integers(0, 300))
        rows.append((i, int(rng.integers(18, 90)), recency, int(rng.integers(1, 9)), float(np.round(rng.lognormal(5, 1), 2)),
                     int(recency > 90), ["B2C", "B2B", None][i % 3], None if i % 10 == 0 else 1.5))
    return spark.createDataFrame(
        rows, "customer_id int, age int, recency_days int, frequency int, monetary double, churned int, customer_segment string, clv double"
    )


def auc(rows):
    pairs = [(a > b) + 0.5 * (a == b) for la, _, a in rows if la == 1 for lb, _, b in rows if lb == 0]
    return sum(pairs) / len(pairs)


def test_auc_with_ties_equals_all_pairs(spark):
    rng = np.random.default_rng(2)
    rows = [(int(rng.integers(0, 2)), 0, float(np.round(rng.random(), int(rng.integers(1, 9))))) for _ in range(300)]
    df = spark.createDataFrame(rows, PREDICTION)
    for cells in (1, 7):
        assert evaluation.roc_auc(df, cells).first().roc_auc == pytest.approx(auc(rows), abs=5.1e-5)
    one_class = df.filter("label = 1")
    assert evaluation.roc_auc(one_class).first().roc_auc is None


def test_auc_of_crowded_scores(spark):
    rng = np.random.default_rng(3)
    rows = [(int(rng.integers(0, 2)), 0, float(s)) for s in np.concatenate([rng.random(150) * 1e-8, 1 - rng.random(150) * 1e-8])]
    df = spark.createDataFrame(rows, PREDICTION)
    assert evaluation.roc_auc(df, 5).first().roc_auc == pytest.approx(auc(rows), abs=5.1e-5)


def test_metrics_without_positive_predictions(spark):
    df = spark.createDataFrame([(1, 0, 0.1), (0, 0, 0.2)], PREDICTION)
    row = evaluation.classification_metrics(df).first()
    assert (row.accuracy, row.precision, row.recall, row.f1) == (0.5, 0.0, 0.0, 0.0)
    cells = {(r.label, r.prediction): r.customers for r in evaluation.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_welch_by_hand(spark):
    rows = [(1, v) for v in (1.0, 2.0, 3.0)] + [(0, v) for v in (4.0, 6.0, 8.0, 10.0)]
    df = spark.createDataFrame(rows, "churned int, monetary double")
    row = statistics.welch(df).first()
    se = 1 / 3 + (20 / 3) / 4
    assert row.t_statistic == pytest.approx(-5 / se**0.5, abs=1e-4)
    assert row.degrees_of_freedom == pytest.approx(se**2 / ((1 / 3) ** 2 / 2 + (5 / 3) ** 2 / 3), abs=1e-4)
    test = statistics.hypothesis_test(df)
    assert test["significant"] and 0.01 < test["p_value"] < 0.05


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0, 0), (2.0, 5.0, 1)], "age double, clv double, churned int")
    got = {r.feature: r.correlation_with_churn for r in statistics.correlation_analysis(df).collect()}
    assert got == {"age": 1.0, "clv": None}


def test_split_keeps_class_shares_and_repeats(spark):
    df = customers(spark)
    first = churn.stratified_split(df.repartition(7)).select("customer_id", "churned", "is_test").collect()
    again = churn.stratified_split(df.repartition(2)).select("customer_id", "churned", "is_test").collect()
    assert sorted(first) == sorted(again) and len(first) == 400
    for label in (0, 1):
        rows = [r.is_test for r in first if r.churned == label]
        assert abs(sum(rows) - 0.2 * len(rows)) <= 1


def test_prepare_features_encodes_and_imputes(spark):
    table, names = churn.prepare_features(customers(spark))
    assert names == ["age", "recency_days", "frequency", "monetary", "clv", "customer_segment"]
    rows = table.collect()
    assert {r.customer_segment for r in rows} == {0, 1, 2} and all(r.clv == 1.5 for r in rows)
    assert "recency_days" not in churn.prepare_features(customers(spark), exclude_leaky=True)[1]


def test_forest_finds_recency(spark):
    fitted = churn.train_churn_model(customers(spark), Config(trees=15, tree_depth=5))
    importance = churn.feature_importance(fitted).collect()
    assert importance[0].feature == "recency_days"
    assert sum(r.importance for r in importance) == pytest.approx(1.0)
    metrics, confusion = evaluation.evaluate_model(fitted.predictions)
    assert metrics.first().roc_auc > 0.95
    assert confusion.agg(F.sum("customers")).first()[0] == fitted.test.count()


def test_forest_predicts_in_a_session_that_observed(spark):
    observed = Observation("rows")
    spark.range(5).observe(observed, F.count(F.lit(1)).alias("n")).count()
    assert observed.get["n"] == 5
    fitted = churn.train_churn_model(customers(spark), Config(trees=3, tree_depth=3))
    assert fitted.predictions.count() == len(fitted.predictions.collect()) == fitted.test.count()


def test_a_null_id_keeps_its_cluster(spark):
    df = customers(spark, 40).withColumn("customer_id", F.when(F.col("customer_id") != 7, F.col("customer_id")))
    clustered, _, _ = kmeans.kmeans_segmentation(df, Config(kmeans_restarts=1))
    assert clustered.count() == 40 and clustered.filter("customer_id is null and kmeans_cluster is not null").count() == 1


def test_clusters_are_named_by_spend(spark):
    df = customers(spark).drop("customer_segment")
    clustered, model, _ = kmeans.kmeans_segmentation(df, Config(kmeans_restarts=2))
    assert clustered.count() == 400 and len(model.clusterCenters()) == 5
    profile = kmeans.cluster_names(kmeans.kmeans_profile(clustered)).orderBy(F.desc("median_monetary")).collect()
    assert [r.kmeans_segment for r in profile] == list(kmeans.CLUSTER_NAMES)
    assert sum(r.customers for r in profile) == 400


def test_codes_of_many_values_with_one_head_are_spread(spark):
    values = [f"common/head/{i:05d}" for i in range(20_000)]
    df = spark.createDataFrame([(v, None if i % 2 else "b") for i, v in enumerate(reversed(values))], "long string, short string")
    codes = churn.label_codes(df, ["long", "short"])
    got = {(r.column_name, r.value): r.code for r in codes.collect()}
    assert [got["long", v] for v in values] == list(range(20_000))
    assert (got["short", "b"], got["short", "nan"], len(got)) == (0, 1, 20_002)
    ranges = df.sparkSession.read.parquet(codes.inputFiles()[0].rsplit("/", 1)[0])
    sizes = [r["count"] for r in ranges.groupBy("_range").count().collect()]
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(sizes) < 10_000


def test_sketches_of_files_merge(spark, tmp_path):
    frame = lambda a, b: spark.range(a, b).selectExpr("id", "CAST(id % 700 AS DOUBLE) AS x", "CAST(id AS STRING) AS s")
    paths = []
    for i, (a, b) in enumerate([(0, 30_000), (20_000, 60_000)]):
        frame(a, b).coalesce(1).write.parquet(str(tmp_path / str(i)))
        paths.append(str(tmp_path / str(i)))
    sketches = profiling.distinct_sketches(spark.read.parquet(*paths), F.input_file_name())
    assert sketches.count() == 2
    got = {r.column_name: r.estimate for r in profiling.merged_estimates(sketches).collect()}
    for column, n in {"id": 60_000, "x": 700, "s": 60_000}.items():
        assert abs(got[column] - n) <= 4 * profiling.sketch_error() * n + 1
