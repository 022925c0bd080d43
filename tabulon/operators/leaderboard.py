"""Leaderboards and winners from the predictions table (LB-*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulon.operators import evaluate as ev

BOARD_METRICS = ["accuracy", "weighted_precision", "weighted_recall", "weighted_f1"]


def leaderboard(preds: DataFrame, datasets=("val", "test"), keys=("model", "version"),
                label="label", prediction="prediction") -> DataFrame:
    """One row per model version: ``<dataset>_<metric>`` for accuracy and weighted P/R/F1.
    Missing combinations stay NULL."""
    m = ev.multiclass_metrics(preds, label, prediction, by=[*keys, "dataset"])
    aggs = [F.max(F.when(F.col("dataset") == F.lit(d), F.col(x))).alias(f"{d}_{x}")
            for d in datasets for x in BOARD_METRICS]
    return m.groupBy(*keys).agg(*aggs)


def winner(board: DataFrame, metric: str = "test_accuracy", keys=("model", "version")) -> DataFrame:
    """Top-1 by ``metric`` (NULLs last; ties to the first key order)."""
    return board.orderBy(F.col(metric).desc_nulls_last(), *keys).limit(1)


def macro_board(preds: DataFrame, dataset: str = "test", keys=("model", "version"),
                label="label", prediction="prediction") -> DataFrame:
    """Mean over classes of precision, recall and F1 (missing skipped), their mean, and rank."""
    pc = ev.per_class_metrics(preds.filter(F.col("dataset") == F.lit(dataset)), label,
                              prediction, by=list(keys))
    g = pc.groupBy(*keys).agg(F.avg("precision").alias("macro_precision"),
                              F.avg("recall").alias("macro_recall"),
                              F.avg("f1_score").alias("macro_f1"))
    overall = (F.col("macro_precision") + F.col("macro_recall") + F.col("macro_f1")) / F.lit(3.0)
    g = g.withColumn("overall", overall)
    # one row per model version: the ranking window covers only the board rows
    rank = F.row_number().over(Window.orderBy(F.col("overall").desc_nulls_last(), *keys))
    return g.withColumn("rank", rank)


def winner_by_macro(preds: DataFrame, dataset: str = "test", keys=("model", "version")) -> DataFrame:
    return winner(macro_board(preds, dataset, keys), "overall", keys).drop("rank")
