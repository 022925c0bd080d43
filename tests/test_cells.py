"""Fits on counted cells of binned rows, and searches that fit a point once."""

import math

import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tabulon.operators import models


def _rows(spark, n):
    return spark.range(n).selectExpr("cast(id % 25 AS double) AS a", "(id * 7919 % 100003) / 3.0D AS b", "cast(id % 25 > 9 AS int) + cast(id * 7919 % 100003 > 60000 AS int) AS y")


def test_fits_are_as_large_as_the_bins_not_the_rows(spark):
    """Every row counts, in a number of cells that the bins bound; the forest's draws are bounded too."""
    with models.TrainingFrame.of(_rows(spark, 90_000), ["a", "b"], "y", folds=3) as rows:
        cells = rows.cells(32, ("cv", 3))
        assert cells.count() <= 25 * 31 * 3
        for k in range(3):
            train = rows.weighted(cells, [j for j in range(3) if j != k]).agg(F.sum(models.N_ROWS)).first()[0]
            assert train == rows.frame.filter(F.col(models.FOLD) != k).count()
            assert rows.weighted(cells, [k]).agg(F.sum(models.N_ROWS)).first()[0] == 90_000 - train
        assert rows.weighted(cells).agg(F.sum(models.WEIGHT)).first()[0] == 90_000


def test_a_forest_bags_single_rows_and_portions_of_many(spark, monkeypatch):
    df = _rows(spark, 6000)
    with models.TrainingFrame.of(df, ["a", "b"], "y", folds=3) as rows:
        sizes = rows.weighted(rows.cells(16, ("cv", 3), bagged=True)).groupBy(models.N_ROWS).count().collect()
        assert [tuple(r) for r in sizes] == [(1.0, 6000)]
    monkeypatch.setattr(models, "BAGGED", 2000)
    with models.TrainingFrame.of(df, ["a", "b"], "y", folds=3) as rows:
        bagged = rows.weighted(rows.cells(16, ("cv", 3), bagged=True))
        total, largest, draws = bagged.agg(F.sum(models.N_ROWS), F.max(models.N_ROWS), F.count(F.lit(1))).first()
        assert total == 6000 and largest == 3 and draws < 3000


def test_a_tree_of_cells_is_the_tree_of_the_rows(spark):
    """With a bin for every value, weighted cells give the rows' tree; classes' weights count."""
    df = spark.range(3000).selectExpr("cast(id % 29 AS double) - 14 AS a", "cast(id * 7 % 11 AS double) AS b",
                                      "cast(id * id % 29 % 3 = 1 AS int) AS y", "1.0D + id * id % 29 % 3 % 2 AS w")
    model = models.train(df, "tree", "y", ["a", "b"], weight="w", params={"maxDepth": 4, "maxBins": 32})
    with models.TrainingFrame.of(df, ["a", "b"], "y", "w") as rows:
        plain = DecisionTreeClassifier(featuresCol=models.FEATURES, labelCol="y", weightCol="w", maxDepth=4, maxBins=32, seed=42).fit(rows.frame)
        want = {(r["a"], r["b"]): r["prediction"] for r in plain.transform(rows.assembler.transform(df)).collect()}
    got = {(r["a"], r["b"]): r["prediction"] for r in model.transform(df).collect()}
    assert got == want and len(set(got.values())) == 2


def test_bin_edges_follow_the_rows_alone(spark):
    """Few values: an edge between any two. Many, of many magnitudes: equal shares, on any layout."""
    few = spark.range(100).selectExpr("cast(id % 4 AS double) AS x").unionByName(spark.sql("SELECT double('-Infinity') AS x UNION ALL SELECT NULL"))
    assert models.bin_edges(few, ["x"], 10) == {"x": [0.5, 1.5, 2.5]}
    wide = spark.range(20_000).selectExpr("exp((id * 7919 % 20000) / 50.0D) AS x")
    edges = models.bin_edges(wide.repartition(3), ["x"], 20)["x"]
    assert edges == models.bin_edges(wide.repartition(7, "x"), ["x"], 20)["x"] and len(edges) <= 19
    bounds = [-math.inf, *edges, math.inf]
    sizes = [wide.filter((F.col("x") >= F.lit(lo)) & (F.col("x") < F.lit(hi))).count() for lo, hi in zip(bounds, bounds[1:])]
    assert len(sizes) >= 18 and max(sizes) <= 2000 and sum(sizes) == 20_000
    heavy = spark.range(10_000).selectExpr("if(id % 2 = 0, 0D, cast(id AS double)) AS x")
    assert 0 < models.bin_edges(heavy, ["x"], 10)["x"][0] <= 1500


def test_a_fit_that_stayed_within_a_smaller_limit_is_not_repeated(spark, monkeypatch):
    fits = []
    fit = DecisionTreeClassifier.fit

    def counted(self, data, params=None):
        fits.append({p.name: v for p, v in (params or {}).items()})
        return fit(self, data, params)

    monkeypatch.setattr(DecisionTreeClassifier, "fit", counted)
    grid = {"maxDepth": [1, 5, 10, 20], "maxBins": [32]}
    model, scores = models.tune(_rows(spark, 3000).withColumn("y", (F.col("a") > 9).cast("int") + (F.col("a") > 17).cast("int")),
                                "tree", "y", ["a", "b"], grid, folds=3)
    tuned = [f["maxDepth"] for f in fits if "maxDepth" in f]
    assert sorted(tuned) == [1, 1, 1, 5, 20, 20, 20]  # the last fit is that of the best point
    assert len(scores) == 4 and scores[0] < 1.0 and scores[1:] == [1.0] * 3 and model.stages[-1].getMaxDepth() == 5


def test_rows_without_a_value_are_refused(spark):
    df = _rows(spark, 300).withColumn("a", F.when(F.col("b") > 9, F.col("a")))
    for family in ("tree", "gbt"):
        with pytest.raises(Exception):
            models.train(df.withColumn("y", (F.col("y") > 0).cast("int")), family, "y", ["a", "b"])


def test_a_grid_of_forests_is_one_fit_per_part_and_scored_whole(spark, monkeypatch):
    """Smaller depths are cut from the deepest forest, with the trees of a fit of that depth; fewer trees
    are its first ones. A forest with too many nodes to go through is fitted for every depth."""
    df = _rows(spark, 3000).withColumn("y", (F.col("y") + F.xxhash64("b") % 2 + 1).cast("int"))
    grid = {"numTrees": [2, 5], "maxDepth": [1, 3, 8], "maxBins": [32]}
    fits = []
    fit = RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, data, params=None: fits.append(params) or fit(self, data, params))
    found = {}
    for walked in (models.WALKED, 0):
        monkeypatch.setattr(models, "WALKED", walked)
        fits.clear()
        _, found[walked] = models.tune(df, "forest", "y", ["a", "b"], grid, folds=3)
        assert len(fits) == (3 if walked else 9) + 1  # the last one is that of the best point
    assert found[20_000] == found[0] and len(set(found[0])) > 3
    with models.TrainingFrame.of(df, ["a", "b"], "y", folds=3) as rows:
        cells = rows.weighted(rows.cells(32, ("cv", 3), bagged=True))
        deep, flat = (fit(models.classifier("forest", "y", models.WEIGHT, numTrees=5, maxDepth=d, maxBins=32), cells) for d in (8, 3))
        names = lambda model: [t.toDebugString.split("\n", 1)[1] for t in model.trees]
        assert names(models._part_of(deep, 5, 3)) == names(flat) != names(deep)
        assert names(models._part_of(deep, 2, 3)) == names(flat)[:2]
        assert names(models._part_of(deep, 2, None)) == names(deep)[:2]


def test_scores_are_those_of_the_evaluator_on_the_rows(spark):
    df = _rows(spark, 900).withColumn("y", (F.col("b") > 9000).cast("int") + (F.col("a") > 17).cast("int"))
    with models.TrainingFrame.of(df, ["a", "b"], "y", folds=3) as rows:
        held = rows.frame.filter(F.col(models.FOLD) == 0)
        model = models.classifier("logistic", "y", maxIter=3).fit(rows.frame)
        cells = rows.weighted(rows.cells(16, ("cv", 3)), [0])
        tree = models.classifier("tree", "y", models.WEIGHT, maxDepth=1).fit(cells)
        for metric in ("accuracy", "f1", "weightedRecall", "logLoss"):
            plain = MulticlassClassificationEvaluator(labelCol="y", metricName=metric)
            weighted = plain.copy({plain.weightCol: models.N_ROWS})
            assert models._score(plain, model, held) == pytest.approx(plain.evaluate(model.transform(held)))
            assert models._score(weighted, tree, cells) == pytest.approx(weighted.evaluate(tree.transform(cells)))


def _noisy(spark):
    return _rows(spark, 400).withColumn("y", (F.col("y") + F.xxhash64("b") % 2 + 1).cast("int")).repartition(2)


def test_a_forest_and_its_search_do_not_depend_on_the_number_of_rows_against_a_limit(spark, monkeypatch):
    """Every row is drawn, also where a cell has many: a limit on portions changes neither model nor scores."""
    grid = {"numTrees": [2, 4], "maxDepth": [3], "maxBins": [16]}
    found = []
    for bagged in (1_000_000, 20):
        monkeypatch.setattr(models, "BAGGED", bagged)
        model, scores = models.tune(_noisy(spark), "forest", "y", ["a", "b"], grid, method="cv", folds=2)
        found.append((scores, [t.toDebugString.split("\n", 1)[1] for t in model.stages[-1].trees]))
    assert found[0] == found[1] and max(found[0][0]) < 1.0


def test_draws_of_counted_rows_are_those_of_their_rows(spark):
    """n rows drawn with mean 1 each: mean and variance n. A tree's draws do not depend on the others asked for."""
    rows = spark.range(0, 4000, 1, 2).select("id", F.when(F.col("id") % 2 == 0, 400.0).otherwise(1.0).alias("_mean"))
    drawn = models._drawn(rows, 42, range(2, 4))
    for n, mean, variance, joint in drawn.groupBy("_mean").agg(F.avg("_drawn3"), F.var_samp("_drawn3"), F.corr("_drawn2", "_drawn3")).collect():
        assert mean == pytest.approx(n, rel=0.1) and variance == pytest.approx(n, rel=0.2) and abs(joint) < 0.1
    alone = models._drawn(rows, 42, range(3, 4))
    assert [tuple(r) for r in alone.collect()] == [tuple(r) for r in drawn.drop("_drawn2").collect()]


def test_a_smaller_forest_is_the_first_trees_of_a_larger_one(spark):
    df, trees = _noisy(spark).withColumn("w", 1.0 + F.col("a") % 3), []
    for n in (2, 3):
        model = models.train(df, "forest", "y", ["a", "b"], weight="w", params={"numTrees": n, "maxDepth": 3, "maxBins": 16})
        trees.append([t.toDebugString.split("\n", 1)[1] for t in model.stages[-1].trees])
    assert trees[0] == trees[1][:2] and len(set(trees[1])) == 3
    assert {r["prediction"] for r in model.transform(df).collect()} <= {0.0, 1.0, 2.0, 3.0}


def test_a_split_search_of_forests_does_not_depend_on_a_limit_on_rows(spark, monkeypatch):
    found = []
    for bagged in (1_000_000, 20):
        monkeypatch.setattr(models, "BAGGED", bagged)
        model, scores = models.tune(_noisy(spark), "forest", "y", ["a", "b"], {"numTrees": [2, 4], "maxDepth": [3], "maxBins": [16]},
                                    method="tvs", ratio=0.7)
        found.append((scores, [t.toDebugString.split("\n", 1)[1] for t in model.stages[-1].trees]))
    assert found[0] == found[1] and max(found[0][0]) < 1.0
