"""Evaluation over a predictions table (EV-*).

Every operator takes ``(df, label, prediction, [score], by)``: the ``by`` columns (model,
version, dataset, segment...) evaluate any number of models in ONE plan. The heavy part is a
Spark aggregation over prediction rows (map-side combined); what follows works on the small
per-(group, class) or per-(group, distinct score) tables. Curves use the distributed
ordered scan of ``tabulon.plans.ordered`` over distinct scores, so one model holding most of
the rows never lands in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions.columns import nan_ratio, ratio_or, safe_ratio
from tabulon.plans.lookup import attach, materialised
from tabulon.plans.ordered import running_sums

BINARY_METRICS = ["accuracy", "precision", "recall", "f1_score"]


def _is(c: str, v) -> Column:
    return F.col(c) == F.lit(v)


# ------------------------------------------------------------------ input check (EV-12)
def prediction_nulls(df: DataFrame, label="label", prediction="prediction", score="score",
                     by=()) -> DataFrame:
    """Rows per group and how many lack a label, a prediction or a score: the table form of
    the reference's equal-length check (a predictions table is aligned by construction)."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(label).isNull()).alias("null_label"),
        F.count_if(F.col(prediction).isNull()).alias("null_prediction"),
        F.count_if(F.col(score).isNull()).alias("null_score"))


# ------------------------------------------------------------------ binary (EV-1..3)
def binary_counts(df: DataFrame, label="label", prediction="prediction", by=()) -> DataFrame:
    """tp / tn / fp / fn for positive class 1, one aggregation."""
    return df.groupBy(*by).agg(
        F.count_if(_is(label, 1) & _is(prediction, 1)).alias("tp"),
        F.count_if(_is(label, 0) & _is(prediction, 0)).alias("tn"),
        F.count_if(_is(label, 0) & _is(prediction, 1)).alias("fp"),
        F.count_if(_is(label, 1) & _is(prediction, 0)).alias("fn"))


def _f1(p: Column, r: Column) -> Column:
    return F.try_divide(F.lit(2.0) * (p * r), p + r)


def binary_metrics(df: DataFrame, label="label", prediction="prediction", by=()) -> DataFrame:
    """accuracy, precision, recall, f1_score; a zero denominator gives NULL."""
    c = binary_counts(df, label, prediction, by)
    tp, tn, fp, fn = (F.col(x) for x in ("tp", "tn", "fp", "fn"))
    p, r = safe_ratio(tp, tp + fp), safe_ratio(tp, tp + fn)
    return c.select(*by, safe_ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
                    p.alias("precision"), r.alias("recall"), _f1(p, r).alias("f1_score"))


def binary_metrics_unguarded(df: DataFrame, label="label", prediction="prediction",
                             by=()) -> DataFrame:
    """numpy-style variant: accuracy = share of equal labels; 0/0 gives NaN."""
    agg = df.groupBy(*by).agg(
        F.count_if(F.col(label) == F.col(prediction)).alias("eq"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(_is(label, 1) & _is(prediction, 1)).alias("tp"),
        F.count_if(_is(prediction, 1)).alias("pp"),
        F.count_if(_is(label, 1)).alias("ap"))
    p, r = nan_ratio(F.col("tp"), F.col("pp")), nan_ratio(F.col("tp"), F.col("ap"))
    f1 = F.when((p + r) == 0, F.lit(float("nan"))).otherwise(F.lit(2.0) * (p * r) / (p + r))
    return agg.select(*by, nan_ratio(F.col("eq"), F.col("n")).alias("accuracy"),
                      p.alias("precision"), r.alias("recall"), f1.alias("f1_score"))


# ------------------------------------------------------------------ multi-class (EV-4..7)
def confusion_counts(df: DataFrame, label="label", prediction="prediction", by=()) -> DataFrame:
    return df.groupBy(*by, label, prediction).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, label="label", prediction="prediction", by=(),
                     zeros: bool = True) -> DataFrame:
    """(by..., label, prediction, n), every row counted; NULL is a class like any other. With
    ``zeros`` also the empty cells over the union of the group's classes: K x K rows per group, made
    by an equi-join of the distinct classes on the group (without it only the cells that occur)."""
    keys = [*by, label, prediction]
    cells = confusion_counts(df, label, prediction, by)
    if not zeros:
        return cells.select(*keys, "n")
    cells = materialised(cells)
    groups = [*by, "_one"]
    seen = cells.withColumn("_one", F.lit(1)).select(
        *groups, F.explode(F.array(F.struct(F.col(label).alias("c")), F.struct(F.col(prediction).alias("c")))).alias("s"))
    classes = seen.select(*groups, F.col("s.c").alias("c")).distinct()
    left = classes.select(*groups, F.col("c").alias(label))
    right = classes.select(*[F.col(g).alias(f"_r_{g}") for g in groups], F.col("c").alias(prediction))
    grid = left.join(right, [F.col(g).eqNullSafe(F.col(f"_r_{g}")) for g in groups]).select(*keys)
    return attach(grid, cells, keys, how="left").select(*keys, F.coalesce("n", F.lit(0)).alias("n"))


def confusion_wide(df: DataFrame, label="label", prediction="prediction", by=(),
                   classes: list | None = None) -> DataFrame:
    """One row per (group, true class), one ``pred_<c>`` column per class (zeros filled); rows
    predicted NULL are in ``pred_null``, present if there are any. Without ``classes`` the columns
    are all classes found, one column each: as many as the wide form has."""
    cells = materialised(confusion_counts(df, label, prediction, by))
    if classes is None:
        found = cells.select(label).union(cells.select(prediction)).distinct().collect()
        classes = sorted({r[0] for r in found if r[0] is not None})
        if not cells.filter(F.col(prediction).isNull()).isEmpty():
            classes.append(None)
    return cells.groupBy(*by, label).agg(*[
        F.coalesce(F.sum(F.when(F.col(prediction).eqNullSafe(F.lit(c)), F.col("n"))), F.lit(0)).cast("long")
        .alias("pred_null" if c is None else f"pred_{c}") for c in classes])


def class_table(df: DataFrame, label="label", prediction="prediction", by=()) -> DataFrame:
    """(by..., class, support, predicted, tp) from the confusion cells, ONE aggregation."""
    cells = confusion_counts(df, label, prediction, by)
    diag = F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(F.lit(0))
    roles = F.array(
        F.struct(F.col(label).alias("cls"), F.col("n").alias("a"), F.lit(0).cast("long").alias("p"),
                 diag.cast("long").alias("t")),
        F.struct(F.col(prediction).alias("cls"), F.lit(0).cast("long").alias("a"),
                 F.col("n").alias("p"), F.lit(0).cast("long").alias("t")))
    return (cells.select(*by, F.inline(roles))
            .groupBy(*by, F.col("cls").alias("class"))
            .agg(F.sum("a").alias("support"), F.sum("p").alias("predicted"),
                 F.sum("t").alias("tp")))


def _class_scores(t: DataFrame) -> DataFrame:
    p = ratio_or(F.col("tp"), F.col("predicted"), 0.0)
    r = ratio_or(F.col("tp"), F.col("support"), 0.0)
    f1 = F.when((p + r) == 0, F.lit(0.0)).otherwise(F.lit(2.0) * (p * r) / (p + r))
    return t.withColumns({"precision": p, "recall": r, "f1_score": f1})


def per_class_metrics(df: DataFrame, label="label", prediction="prediction", by=(),
                      classes_from: str = "label") -> DataFrame:
    """(by..., class, precision, recall, f1_score, support); zero denominators give 0.
    ``classes_from='label'`` keeps classes seen in the labels, ``'union'`` all classes."""
    t = class_table(df, label, prediction, by)
    if classes_from == "label":
        t = t.filter(F.col("support") > 0)
    return _class_scores(t).select(*by, "class", "precision", "recall", "f1_score", "support")


def classification_report(df: DataFrame, label="label", prediction="prediction",
                          by=()) -> DataFrame:
    """Per class (union of labels and predictions) P/R/F1/support plus 'accuracy',
    'macro avg' and 'weighted avg' rows; ``class_label`` is text."""
    t = _class_scores(class_table(df, label, prediction, by))
    per_class = t.select(*by, F.col("class").cast("string").alias("class_label"), "precision",
                         "recall", "f1_score", "support")
    g = t.groupBy(*by).agg(
        F.sum("tp").alias("_tp"), F.sum("support").alias("_n"),
        F.avg("precision").alias("_mp"), F.avg("recall").alias("_mr"), F.avg("f1_score").alias("_mf"),
        F.sum(F.col("precision") * F.col("support")).alias("_wp"),
        F.sum(F.col("recall") * F.col("support")).alias("_wr"),
        F.sum(F.col("f1_score") * F.col("support")).alias("_wf"))
    n = F.col("_n").cast("double")
    acc = g.select(*by, F.lit("accuracy").alias("class_label"),
                   F.lit(None).cast("double").alias("precision"),
                   F.lit(None).cast("double").alias("recall"),
                   safe_ratio(F.col("_tp"), F.col("_n")).alias("f1_score"), F.col("_n").alias("support"))
    macro = g.select(*by, F.lit("macro avg").alias("class_label"), F.col("_mp").alias("precision"),
                     F.col("_mr").alias("recall"), F.col("_mf").alias("f1_score"),
                     F.col("_n").alias("support"))
    weighted = g.select(*by, F.lit("weighted avg").alias("class_label"),
                        F.try_divide(F.col("_wp"), n).alias("precision"),
                        F.try_divide(F.col("_wr"), n).alias("recall"),
                        F.try_divide(F.col("_wf"), n).alias("f1_score"), F.col("_n").alias("support"))
    return per_class.unionByName(acc).unionByName(macro).unionByName(weighted)


def multiclass_metrics(df: DataFrame, label="label", prediction="prediction", by=()) -> DataFrame:
    """accuracy, weighted_precision, weighted_recall, weighted_f1 (weights = support, classes
    from the labels), as ``MulticlassClassificationEvaluator`` defines them."""
    t = _class_scores(class_table(df, label, prediction, by).filter(F.col("support") > 0))
    g = t.groupBy(*by).agg(
        F.sum("tp").alias("_tp"), F.sum("support").alias("_n"),
        F.sum(F.col("precision") * F.col("support")).alias("_wp"),
        F.sum(F.col("recall") * F.col("support")).alias("_wr"),
        F.sum(F.col("f1_score") * F.col("support")).alias("_wf"))
    n = F.col("_n").cast("double")
    return g.select(*by, safe_ratio(F.col("_tp"), F.col("_n")).alias("accuracy"),
                    F.try_divide(F.col("_wp"), n).alias("weighted_precision"),
                    F.try_divide(F.col("_wr"), n).alias("weighted_recall"),
                    F.try_divide(F.col("_wf"), n).alias("weighted_f1"))


# ------------------------------------------------------------------ curves (EV-8..11)
def score_groups(df: DataFrame, label="label", score="score", by=(),
                 following: tuple[str, ...] = ()) -> DataFrame:
    """(by..., score, tp, fp, tp_cum, fp_cum, P, N): one row per distinct score, counts of
    positives/negatives at that score and cumulated from the highest score down; ``next_<col>`` of
    the columns ``following`` on the next lower score."""
    keys = list(by) or ["_all"]
    if not by:
        df = df.withColumn("_all", F.lit(0))
    groups = (df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
              .groupBy(*keys, score)
              .agg(F.count_if(_is(label, 1)).alias("tp"), F.count_if(~_is(label, 1)).alias("fp")))
    cum = running_sums(groups, keys, [(score, True)], ["tp", "fp"], totals=True, following=following)
    out = cum.withColumnsRenamed({"tp_total": "P", "fp_total": "N"})
    return out if by else out.drop("_all")


def _highest() -> Column:
    """Is it the row of a group's highest score? Nothing was counted before it."""
    return (F.col("tp_cum") == F.col("tp")) & (F.col("fp_cum") == F.col("fp"))


def _with_end_point(g: DataFrame, by, point: dict[str, Column], end: dict[str, Column]) -> DataFrame:
    """The curve points of score groups, and each group's end point beside its highest score: both
    from the same pass."""
    own, extra = (F.struct(*[F.col(k) for k in by], *[v.cast("double").alias(n) for n, v in p.items()]) for p in (point, end))
    return g.select(F.inline(F.when(_highest(), F.array(extra, own)).otherwise(F.array(own))))


def roc_curve(df: DataFrame, label="label", score="score", by=(),
              drop_intermediate: bool = False) -> DataFrame:
    """(by..., threshold, fpr, tpr): one point per distinct score (descending, ties grouped)
    plus the start point (threshold +Inf, 0, 0). ``drop_intermediate`` keeps, besides the
    first and last point, only points where the curve changes direction (the step to the
    next point differs from the step into this one), as scikit-learn's default does."""
    g = score_groups(df, label, score, by, following=("tp", "fp") if drop_intermediate else ())
    if drop_intermediate:
        g = g.filter(_highest() | F.col("next_fp").isNull() | (F.col("next_fp") != F.col("fp"))
                     | (F.col("next_tp") != F.col("tp")))
    return _with_end_point(
        g, by, {"threshold": F.col(score), "fpr": safe_ratio(F.col("fp_cum"), F.col("N")),
                "tpr": safe_ratio(F.col("tp_cum"), F.col("P"))},
        {"threshold": F.lit(float("inf")), "fpr": F.lit(0.0), "tpr": F.lit(0.0)})


def roc_auc(df: DataFrame, label="label", score="score", by=()) -> DataFrame:
    """Trapezoidal area under the ROC curve = the Mann-Whitney statistic, in counts:
    sum(fp * (2 * tp_before + tp)) / (2 P N). NULL when a group has one class only."""
    g = score_groups(df, label, score, by)
    term = F.col("fp").cast("double") * (F.lit(2.0) * (F.col("tp_cum") - F.col("tp")).cast("double")
                                         + F.col("tp").cast("double"))
    agg = g.groupBy(*by).agg(F.sum(term).alias("_num"), F.first("P").alias("P"),
                             F.first("N").alias("N"))
    den = F.lit(2.0) * F.col("P").cast("double") * F.col("N").cast("double")
    return agg.select(*by, F.try_divide(F.col("_num"), den).alias("roc_auc"))


def _precision_before() -> Column:
    tp0, fp0 = F.col("tp_cum") - F.col("tp"), F.col("fp_cum") - F.col("fp")
    return ratio_or(tp0, tp0 + fp0, 1.0)


def pr_curve(df: DataFrame, label="label", score="score", by=()) -> DataFrame:
    """(by..., threshold, precision, recall) per distinct score plus the end point
    (recall 0, precision 1, threshold NULL). Without positives recall is 1."""
    g = score_groups(df, label, score, by)
    recall = F.when(F.col("P") == 0, F.lit(1.0)).otherwise(
        F.col("tp_cum").cast("double") / F.col("P").cast("double"))
    return _with_end_point(
        g, by, {"threshold": F.col(score), "precision": safe_ratio(F.col("tp_cum"), F.col("tp_cum") + F.col("fp_cum")),
                "recall": recall},
        {"threshold": F.lit(None), "precision": F.lit(1.0), "recall": F.lit(0.0)})


def pr_auc(df: DataFrame, label="label", score="score", by=()) -> DataFrame:
    """Trapezoidal area under the PR curve starting at (recall 0, precision 1), the
    convention of ``auc(recall, precision)``; differs from Spark's ``areaUnderPR``."""
    g = score_groups(df, label, score, by)
    prec = F.col("tp_cum").cast("double") / (F.col("tp_cum") + F.col("fp_cum")).cast("double")
    term = (F.col("tp").cast("double") / F.col("P").cast("double")) * (prec + _precision_before()) / F.lit(2.0)
    agg = g.filter(F.col("P") > 0).groupBy(*by).agg(F.sum(term).alias("pr_auc"))
    return agg


def evaluate(df: DataFrame, label="label", prediction="prediction", score="score",
             by=()) -> DataFrame:
    """Long metric rows (by..., metric, value): accuracy, precision, recall, f1_score,
    roc_auc, pr_auc for every group, from ONE scan of the predictions.

    The per-(group, score) aggregation carries both the curve counts (rows with a score and
    a label) and the confusion counts (all rows); the ordered scan runs over the distinct
    scores, and the per-group sums of both come from the same written table."""
    keys = list(by) or ["_all"]
    if not by:
        df = df.withColumn("_all", F.lit(0))
    curve_row = F.col(score).isNotNull() & F.col(label).isNotNull()
    groups = df.groupBy(*keys, score).agg(
        F.count_if(curve_row & _is(label, 1)).alias("tp"),
        F.count_if(curve_row & ~_is(label, 1)).alias("fp"),
        F.count_if(_is(label, 1) & _is(prediction, 1)).alias("c_tp"),
        F.count_if(_is(label, 0) & _is(prediction, 0)).alias("c_tn"),
        F.count_if(_is(label, 0) & _is(prediction, 1)).alias("c_fp"),
        F.count_if(_is(label, 1) & _is(prediction, 0)).alias("c_fn"))
    g = running_sums(groups, keys, [(score, True)], ["tp", "fp"], totals=True)
    g = g.withColumnsRenamed({"tp_total": "P", "fp_total": "N"})
    term_roc = F.col("fp").cast("double") * (F.lit(2.0) * (F.col("tp_cum") - F.col("tp")).cast("double")
                                             + F.col("tp").cast("double"))
    prec = safe_ratio(F.col("tp_cum"), F.col("tp_cum") + F.col("fp_cum"))
    term_pr = F.when((F.col("P") > 0) & F.col(score).isNotNull(),
                     (F.col("tp").cast("double") / F.col("P").cast("double"))
                     * (prec + _precision_before()) / F.lit(2.0))
    sums = g.groupBy(*keys).agg(
        F.sum("c_tp").alias("tp"), F.sum("c_tn").alias("tn"), F.sum("c_fp").alias("fp"),
        F.sum("c_fn").alias("fn"),
        F.try_divide(F.sum(term_roc), F.lit(2.0) * F.first("P").cast("double")
                     * F.first("N").cast("double")).alias("roc_auc"),
        F.sum(term_pr).alias("pr_auc"))
    tp, tn, fp, fn = (F.col(x) for x in ("tp", "tn", "fp", "fn"))
    p, r = safe_ratio(tp, tp + fp), safe_ratio(tp, tp + fn)
    wide = sums.select(*keys, safe_ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
                       p.alias("precision"), r.alias("recall"), _f1(p, r).alias("f1_score"),
                       "roc_auc", "pr_auc")
    long = wide.unpivot(keys, [*BINARY_METRICS, "roc_auc", "pr_auc"], "metric", "value")
    return long if by else long.drop("_all")
