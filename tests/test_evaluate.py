import itertools

import numpy as np
import pytest

from tabulon.operators import evaluate as ev


def _brute_auc(labels, scores):
    pos = [s for l, s in zip(labels, scores) if l == 1]
    neg = [s for l, s in zip(labels, scores) if l != 1]
    if not pos or not neg:
        return None
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return wins / (len(pos) * len(neg))


def _brute_pr_auc(labels, scores):
    P = sum(1 for l in labels if l == 1)
    pts = [(0.0, 1.0)]
    for t in sorted(set(scores), reverse=True):
        sel = [l for l, s in zip(labels, scores) if s >= t]
        tp = sum(1 for l in sel if l == 1)
        pts.append((tp / P, tp / len(sel)))
    return sum((r1 - r0) * (p1 + p0) / 2 for (r0, p0), (r1, p1) in zip(pts, pts[1:]))


@pytest.fixture
def preds(spark):
    rng = np.random.default_rng(11)
    rows = []
    for m in ("a", "b"):
        for i in range(300):
            label = int(rng.random() < 0.4)
            score = float(np.round(rng.random() * 0.6 + 0.3 * label, 2))  # many tied scores
            rows.append((m, i, label, int(score >= 0.5), score))
    return spark.createDataFrame(rows, "model string, row_id long, label int, prediction int, score double")


def test_roc_and_pr_auc_against_brute_force(spark, preds):
    pdf = preds.toPandas()
    roc = {r["model"]: r["roc_auc"] for r in ev.roc_auc(preds, by=["model"]).collect()}
    pr = {r["model"]: r["pr_auc"] for r in ev.pr_auc(preds, by=["model"]).collect()}
    for m, g in pdf.groupby("model"):
        assert roc[m] == pytest.approx(_brute_auc(g["label"].tolist(), g["score"].tolist()), abs=1e-12)
        assert pr[m] == pytest.approx(_brute_pr_auc(g["label"].tolist(), g["score"].tolist()), abs=1e-12)


def test_roc_curve_shape(spark, preds):
    curve = ev.roc_curve(preds, by=["model"]).toPandas()
    for m, g in curve.groupby("model"):
        g = g.sort_values("threshold", ascending=False)
        assert g.iloc[0]["fpr"] == 0 and g.iloc[0]["tpr"] == 0
        assert g.iloc[-1]["fpr"] == 1 and g.iloc[-1]["tpr"] == 1
        assert (np.diff(g["tpr"].to_numpy()) >= 0).all()


def test_single_class_auc_is_null(spark):
    df = spark.createDataFrame([(1, 1, 0.3), (1, 1, 0.9)], "label int, prediction int, score double")
    assert ev.roc_auc(df).collect()[0]["roc_auc"] is None


def test_no_predicted_positives(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (1, 0)], "label int, prediction int")
    r = ev.binary_metrics(df).collect()[0]
    assert r["precision"] is None and r["f1_score"] is None and r["recall"] == 0.0
    assert r["accuracy"] == pytest.approx(1 / 3)
    u = ev.binary_metrics_unguarded(df).collect()[0]
    assert np.isnan(u["precision"]) and np.isnan(u["f1_score"])


def test_confusion_matrix_has_zero_cells(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 1)], "label int, prediction int")
    cm = {(r["label"], r["prediction"]): r["n"] for r in ev.confusion_matrix(df).collect()}
    assert len(cm) == 9 and cm[(3, 1)] == 1 and cm[(3, 3)] == 0
    wide = {r["label"]: (r["pred_1"], r["pred_2"], r["pred_3"]) for r in ev.confusion_wide(df).collect()}
    assert wide[3] == (1, 0, 0)


def test_per_class_and_report(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (2, 1)], "label int, prediction int")
    pc = {r["class"]: (r["precision"], r["recall"], r["support"]) for r in ev.per_class_metrics(df).collect()}
    assert pc[0] == (1.0, 0.5, 2)
    assert pc[1] == (0.5, 1.0, 2)
    assert pc[2] == (0.0, 0.0, 1)  # zero denominator -> 0
    rep = {r["class_label"]: r for r in ev.classification_report(df).collect()}
    assert rep["accuracy"]["f1_score"] == pytest.approx(3 / 5)
    assert rep["macro avg"]["recall"] == pytest.approx((0.5 + 1.0 + 0.0) / 3)
    mc = ev.multiclass_metrics(df).collect()[0]
    assert mc["accuracy"] == pytest.approx(0.6)
    assert mc["weighted_recall"] == pytest.approx(0.6)


def test_evaluate_long_rows(spark, preds):
    rows = ev.evaluate(preds, by=["model"]).collect()
    assert {r["metric"] for r in rows} == {"accuracy", "precision", "recall", "f1_score",
                                           "roc_auc", "pr_auc"}
    assert len(rows) == 12


def _brute_roc_dropped(labels, scores):
    thr = sorted(set(scores), reverse=True)
    tps = np.array([sum(1 for l, s in zip(labels, scores) if s >= t and l == 1) for t in thr])
    fps = np.array([sum(1 for l, s in zip(labels, scores) if s >= t and l != 1) for t in thr])
    keep = np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True]
    return {t for t, k in zip(thr, keep) if k}


def test_roc_drop_intermediate_matches_rule(spark, preds):
    pdf = preds.toPandas()
    out = ev.roc_curve(preds, by=["model"], drop_intermediate=True).toPandas()
    for m, g in pdf.groupby("model"):
        got = set(out[(out["model"] == m) & np.isfinite(out["threshold"])]["threshold"])
        assert got == _brute_roc_dropped(g["label"].tolist(), g["score"].tolist())


def test_confusion_matrix_of_many_classes_and_nulls(spark):
    many = spark.range(5000).selectExpr("cast(id as int) as label", "cast((id * 7) % 5000 as int) as prediction")
    assert ev.confusion_matrix(many, zeros=False).count() == 5000
    rows = [(1, 1), (1, None), (None, 1), (2, 1)]
    holed = spark.createDataFrame(rows, "label int, prediction int")
    cells = {(r["label"], r["prediction"]): r["n"] for r in ev.confusion_matrix(holed).collect()}
    assert len(cells) == 9 and sum(cells.values()) == 4 and cells[(None, 1)] == 1 and cells[(2, 2)] == 0
    wide = {r["label"]: r.asDict() for r in ev.confusion_wide(holed).collect()}
    assert wide[1]["pred_null"] == 1 and wide[None]["pred_1"] == 1
    assert sum(v for r in wide.values() for k, v in r.items() if k != "label") == 4


def test_confusion_wide_of_double_labels(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 1.0)], "label double, prediction double")
    wide = {r["label"]: r.asDict() for r in ev.confusion_wide(df).collect()}
    assert wide[0.0]["pred_1.0"] == 1 and wide[1.0]["pred_0.0"] == 0


def test_retrain_rule_on_missing_and_nan_metrics(spark):
    from tabulon.operators import scoring

    schema = "model string, metric string, value double"
    old = spark.createDataFrame([(m, "accuracy", 0.5) for m in ("nan", "null", "absent", "same")], schema)
    new = spark.createDataFrame([("nan", "accuracy", float("nan")), ("null", "accuracy", None),
                                 ("same", "accuracy", 0.5), ("first", "accuracy", 0.1)], schema)
    found = scoring.compare_metrics(old, new, ["model"])
    improved = {r["model"]: r["improved"] for r in found.collect()}
    assert improved == {"nan": False, "null": False, "absent": False, "same": True, "first": None}
    decided = {r["model"]: r["decision"] for r in scoring.retrain_decision(found, ["model"]).collect()}
    assert decided == {"nan": "retrain", "null": "retrain", "absent": "retrain", "same": "keep", "first": "keep"}


def test_evaluate_single_scan_matches_parts_with_null_scores(spark, preds):
    from pyspark.sql import functions as F

    holed = preds.withColumn("score", F.when(F.col("row_id") % 10 == 0, F.lit(None))
                             .otherwise(F.col("score")))
    got = {(r["model"], r["metric"]): r["value"] for r in ev.evaluate(holed, by=["model"]).collect()}
    for r in ev.binary_metrics(holed, by=["model"]).collect():
        for m in ("accuracy", "precision", "recall", "f1_score"):
            assert got[(r["model"], m)] == pytest.approx(r[m])
    for r in ev.roc_auc(holed, by=["model"]).collect():
        assert got[(r["model"], "roc_auc")] == pytest.approx(r["roc_auc"])
    for r in ev.pr_auc(holed, by=["model"]).collect():
        assert got[(r["model"], "pr_auc")] == pytest.approx(r["pr_auc"])
