"""Cross-checks against Spark ML's evaluators where the definitions agree, and the documented
difference where they do not (PR AUC start point)."""

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabulon.operators import evaluate as ev


@pytest.fixture
def scored(spark):
    rng = np.random.default_rng(21)
    rows = []
    for i in range(800):
        label = int(rng.random() < 0.35)
        score = float(np.round(rng.random() * 0.7 + 0.25 * label, 3))
        rows.append((i, label, int(score >= 0.5), score))
    df = spark.createDataFrame(rows, "row_id long, label int, prediction int, score double")
    return df.withColumn("raw", array_to_vector(F.array(F.lit(1.0) - F.col("score"), F.col("score"))))


def test_roc_auc_equals_spark_exact_evaluator(spark, scored):
    ours = ev.roc_auc(scored).collect()[0]["roc_auc"]
    spark_auc = BinaryClassificationEvaluator(rawPredictionCol="raw", labelCol="label",
                                              metricName="areaUnderROC", numBins=0).evaluate(
        scored.withColumn("label", F.col("label").cast("double")))
    assert ours == pytest.approx(spark_auc, abs=1e-12)


def test_pr_auc_differs_from_spark_area_under_pr(spark, scored):
    # one positive and one negative share the top score, so the first precision is 0.5
    top = spark.createDataFrame([(10_000, 1, 1, 1.0), (10_001, 0, 1, 1.0)],
                                "row_id long, label int, prediction int, score double")
    top = top.withColumn("raw", array_to_vector(F.array(F.lit(1.0) - F.col("score"), F.col("score"))))
    df = scored.unionByName(top)
    ours = ev.pr_auc(df).collect()[0]["pr_auc"]
    spark_pr = BinaryClassificationEvaluator(rawPredictionCol="raw", labelCol="label",
                                             metricName="areaUnderPR", numBins=0).evaluate(
        df.withColumn("label", F.col("label").cast("double")))
    positives = df.filter(F.col("label") == 1).count()
    # ours starts the curve at (recall 0, precision 1), Spark at (0, first precision): the
    # first trapezoid differs by (tp_top / P) * (1 - precision_top) / 2
    assert ours - spark_pr == pytest.approx((1 / positives) * (1 - 0.5) / 2, abs=1e-12)


def test_weighted_metrics_equal_spark_multiclass_evaluator(spark):
    rng = np.random.default_rng(5)
    rows = [(int(l), int(p)) for l, p in zip(rng.integers(0, 4, 600), rng.integers(0, 4, 600))]
    df = spark.createDataFrame(rows, "label int, prediction int")
    ours = ev.multiclass_metrics(df).collect()[0]
    dd = df.select(F.col("label").cast("double"), F.col("prediction").cast("double"))
    for ours_name, spark_name in [("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
                                  ("weighted_recall", "weightedRecall"), ("weighted_f1", "f1")]:
        value = MulticlassClassificationEvaluator(metricName=spark_name).evaluate(dd)
        assert ours[ours_name] == pytest.approx(value, abs=1e-12), ours_name
