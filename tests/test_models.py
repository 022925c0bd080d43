import tempfile

import pytest
from pyspark.sql import functions as F

from tabulon.operators import models, scoring
from tabulon.sources.models import load_model, save_model


def _separable(spark):
    rows = [(float(i % 30), float((i * 7) % 11), 1 + (i % 30) // 10) for i in range(600)]
    return spark.createDataFrame(rows, "q double, noise double, y int")


def test_fit_beats_majority_and_reload_scores_identical(spark):
    df = _separable(spark)
    model = models.train(df, "tree", "y", ["q", "noise"], params={"maxDepth": 4})
    pred = model.transform(df)
    acc = pred.filter(F.col("y") == F.col("prediction")).count() / 600
    assert acc > 0.9  # majority class is ~1/3
    path = tempfile.mkdtemp(prefix="tabulon-model-")
    save_model(model, path)
    again = load_model(path).transform(df)
    a = sorted((r["q"], r["noise"], r["prediction"]) for r in pred.collect())
    b = sorted((r["q"], r["noise"], r["prediction"]) for r in again.collect())
    assert a == b


def test_probabilities_sum_to_one(spark):
    df = _separable(spark)
    model = models.train(df, "logistic", "y", ["q", "noise"], params={"maxIter": 10})
    scored = scoring.positive_score(model.transform(df), index=1)
    from pyspark.ml.functions import vector_to_array
    sums = scored.select(F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, x: a + x)
                         .alias("s")).collect()
    assert all(abs(r["s"] - 1.0) < 1e-9 for r in sums)


def test_tune_cv_returns_metrics(spark):
    df = _separable(spark)
    best, scores = models.tune(df, "logistic", "y", ["q", "noise"], {"regParam": [0.1, 0.01]},
                               method="cv", folds=2)
    assert len(scores) == 2 and best is not None


def test_pick_champion_needs_all_criteria(spark):
    rows = [("m1", 1, 0.8, 0.7, 0.9), ("m2", 1, 0.9, 0.8, 0.85), ("m3", 1, 0.85, 0.75, 0.95),
            ("m4", 1, 0.81, 0.71, 0.91)]
    df = spark.createDataFrame(rows, "model string, version int, accuracy double, f1_score double, roc_auc double")
    champ = models.pick_champion(df, ["model"]).collect()[0]
    # m2 loses on roc_auc; m3 beats m1 everywhere; m4 does not beat m3
    assert champ["model"] == "m3"


def test_compare_and_decision(spark):
    old = spark.createDataFrame([("m", "accuracy", 0.8), ("m", "f1_score", 0.7)],
                                "model string, metric string, value double")
    new = spark.createDataFrame([("m", "accuracy", 0.85), ("m", "f1_score", 0.6), ("m", "roc_auc", 0.9)],
                                "model string, metric string, value double")
    cmp = {r["metric"]: r for r in scoring.compare_metrics(old, new, ["model"]).collect()}
    assert cmp["accuracy"]["improved"] is True and cmp["f1_score"]["improved"] is False
    assert cmp["roc_auc"]["improved"] is None and cmp["roc_auc"]["note"]
    dec = scoring.retrain_decision(scoring.compare_metrics(old, new, ["model"]), ["model"]).collect()
    assert dec[0]["decision"] == "retrain"


def test_train_and_pick_returns_a_scoring_champion(spark):
    rows = [(i, float(i % 20), float((i * 3) % 7), int(i % 20 >= 10)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y int")
    from tabulon.operators import split
    parts = split.hash_split(df, "id", [0.7, 0.3], names=("train", "test"))
    champ, model, metrics, preds = models.train_and_pick(
        parts.filter(F.col("split") == "train"), {"test": parts.filter(F.col("split") == "test")},
        {"logistic": {"regParam": [0.01]}, "tree": {"maxDepth": [3]}}, "y", ["a", "b"], "id",
        folds=2)
    assert champ in ("logistic", "tree")
    assert metrics.filter(F.col("metric") == "roc_auc").count() == 2
    assert model.transform(df).filter(F.col("prediction") == F.col("y")).count() / 400 > 0.8


def test_training_rows_are_spread_and_do_not_depend_on_their_place(spark):
    """A row that is repeated a million times is spread evenly; folds and places follow from values."""
    hot = spark.range(1_000_000).selectExpr("1.5D AS a", "cast(0 AS int) AS y")
    rows = spark.range(3000).selectExpr("cast(id % 700 AS double) AS a", "cast(id % 2 AS int) AS y").unionAll(hot)
    laid = models.laid_out(rows, ["a", "y"], rows_per_partition=50_000, folds=3)
    sizes = [r["count"] for r in laid.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 21 and sum(sizes) == 1_003_000 and max(sizes) < 1.25 * min(sizes)
    folds = [r["count"] for r in laid.filter("a = 1.5").groupBy(models.FOLD).count().collect()]
    assert len(folds) == 3 and max(folds) < 1.02 * min(folds)

    def placed(df):
        out = models.laid_out(df, ["a", "y"], rows_per_partition=500, folds=3)
        return out.select("a", "y", models.FOLD, F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("o")).collect()

    few = spark.range(3000).selectExpr("cast(id % 700 AS double) AS a", "cast(id % 2 AS int) AS y")
    assert placed(few.repartition(2)) == placed(few.repartition(9, "y").sortWithinPartitions("a"))
    assert models.laid_out(few.limit(0), ["a", "y"]).count() == 0


def test_the_same_model_from_any_partitioning(spark):
    df = _separable(spark).withColumn("noisy", ((F.col("q") + F.col("noise")) % 3).cast("int"))
    trees = []
    for parts in (1, 7):
        model = models.train(df.repartition(parts), "forest", "noisy", ["q", "noise"],
                             params={"numTrees": 7, "maxDepth": 4}, rows_per_partition=100)
        trees.append(model.stages[-1].toDebugString.split("\n", 1)[1])
    assert trees[0] == trees[1]


def test_grid_scores_are_those_of_single_fits(spark):
    """All fits go through one pool, the largest first; scores come back in the order of the grid."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    df = _separable(spark).withColumn("noisy", ((F.col("q") * 3 + F.col("noise")) % 5 > 2).cast("int"))
    grid = {"maxDepth": [1, 6, 3], "maxBins": [8, 32]}
    with models.TrainingFrame.of(df, ["q", "noise"], "noisy", folds=3, rows_per_partition=200) as rows:
        model, scores = models.tune(None, "tree", "noisy", ["q", "noise"], grid, rows=rows, parallelism=4)
        points = models.param_grid(models.classifier("tree", "noisy"), grid)
        ev = MulticlassClassificationEvaluator(labelCol="noisy", metricName="accuracy")
        want = []
        for point in points:
            plain = {p.name: v for p, v in point.items()}
            fits = [(models.classifier("tree", "noisy", **plain).fit(rows.frame.filter(F.col(models.FOLD) != k)), k) for k in range(3)]
            want.append(sum(ev.evaluate(m.transform(rows.frame.filter(F.col(models.FOLD) == k))) for m, k in fits) / 3)
        assert [round(x, 9) for x in scores] == [round(x, 9) for x in want]
        best = {p.name: v for p, v in points[scores.index(max(scores))].items()}
        assert model.stages[-1].getMaxDepth() == best["maxDepth"] and model.stages[-1].getMaxBins() == best["maxBins"]
        order = sorted(range(6), key=lambda k: -models._work(points[k]))
        assert {p.name: v for p, v in points[order[0]].items()} == {"maxDepth": 6, "maxBins": 32}
        with pytest.raises(ValueError):
            models.tune(None, "tree", "noisy", ["q", "noise"], grid, folds=2, rows=rows)


def test_without_test_rows_the_first_family_stays(spark):
    rows = [(i, float(i % 20), int(i % 20 >= 10)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, a double, y int")
    champ, model, _, _ = models.train_and_pick(df, {"test": df.limit(0)}, {"tree": {"maxDepth": [2]}, "logistic": {"regParam": [0.1]}},
                                               "y", ["a"], "id", folds=2)
    assert champ == "tree" and model.transform(df).count() == 200


def _tuned(monkeypatch, spark, key):
    """The (family, grid, method, folds, fixed) that a key hands to the tuner."""
    from tabulon.plans.catalog import QUERIES
    from tests.conftest import SF_SMALL

    seen, given = [], []
    of = models.TrainingFrame.of

    def tune(df, family, label, features, grid, method="cv", folds=3, fixed=None, weight=None, rows=None, **_):
        seen.append((family, grid, method, folds if method == "cv" else None, fixed))
        return models.train(given[-1] if df is None else df, "tree", label, features, weight=weight,
                            params={"maxDepth": 5, "maxBins": 64}), [1.0]

    def frame(df, *args, **kwargs):
        given.append(df)
        return of(df, *args, **kwargs)

    monkeypatch.setattr(models, "tune", tune)
    monkeypatch.setattr(models.TrainingFrame, "of", frame)
    QUERIES[key](spark, SF_SMALL)
    return seen


def test_tuning_keys_search_the_whole_grids(spark, monkeypatch):
    assert _tuned(monkeypatch, spark, "tune_cv") == [
        (f, models.CV_GRIDS[f], "cv", 3, None) for f in ("logistic", "tree", "forest")]
    assert _tuned(monkeypatch, spark, "tune_tvs") == [
        (f, models.TVS_GRIDS[f], "tvs", None, None) for f in ("logistic", "forest")]
    assert _tuned(monkeypatch, spark, "tune_gbt_ovr") == [("gbt", models.TVS_GRIDS["gbt"], "tvs", None, {"maxIter": 10})]


def test_suites_and_retraining_search_the_whole_grids(spark, monkeypatch):
    assert _tuned(monkeypatch, spark, "train_suite") == [
        (f, models.CV_GRIDS[f], "cv", 3, None) for f in ("logistic", "tree", "forest")]
    assert _tuned(monkeypatch, spark, "train_champion") == [
        (f, models.CV_GRIDS[f], "cv", 3, None) for f in ("tree", "forest")]
    retrained = _tuned(monkeypatch, spark, "retrain_if_needed")
    assert retrained and all(t == (t[0], models.CV_GRIDS[t[0]], "cv", 3, None) for t in retrained)
