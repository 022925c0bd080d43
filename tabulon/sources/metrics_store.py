"""Metric log and model-version lookups over tables (IO-6..8).

The reference kept metrics in an external tracking service as a flat ``name -> value`` map;
here they are rows (model, version, dataset, metric, value) of a run in a Parquet table, so a
leaderboard is a query over that table or over the predictions table directly.

The table is keyed by the run: logging a run replaces what was logged under its id, in one commit of
the file protocol, and leaves all other runs alone. A job that is repeated after a failure, or twice
by mistake, therefore leaves the same rows as one that ran once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.plans.lookup import attach, materialised

METRIC_NAMES = ["accuracy", "precision", "recall", "f1_score", "roc_auc", "pr_auc"]
#: Partition column of the log and what its values begin with, so that every run id is read as text.
RUN, RUN_PREFIX = "_run", "run:"


def log_metrics(metrics: DataFrame, path: str, run_id: str) -> None:
    """Rows of a run, in place of those that were logged for it before. An empty frame logs nothing
    and replaces nothing."""
    (metrics.drop("run_id").withColumn(RUN, F.lit(f"{RUN_PREFIX}{run_id}")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(RUN).parquet(path))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """All logged rows with their ``run_id``; a filter on it prunes the scan to the run."""
    logged = spark.read.parquet(path)
    return logged.withColumn("run_id", F.substring(F.col(RUN), len(RUN_PREFIX) + 1, 1 << 20)).drop(RUN)


def read_run(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """The rows of one run: only its folder is read."""
    return spark.read.parquet(path).filter(F.col(RUN) == F.lit(f"{RUN_PREFIX}{run_id}")).drop(RUN)


def metrics_for(runs: DataFrame, models: list[str] | None = None,
                metrics: list[str] = METRIC_NAMES,
                keys=("model", "version", "dataset")) -> DataFrame:
    """One wide row per (model, version, dataset) with one column per listed metric; of several runs
    that logged it the last one by ``run_id``. The pivot values are listed, so no extra job discovers
    them."""
    df = runs if not models else runs.filter(F.col("model").isin(*models))
    value = F.max_by("value", "run_id") if "run_id" in runs.columns else F.max("value")
    return df.groupBy(*keys).pivot("metric", metrics).agg(value)


def model_versions(preds: DataFrame) -> DataFrame:
    """(model, version, n_rows) present in the predictions table."""
    return preds.groupBy("model", "version").agg(F.count(F.lit(1)).alias("n_rows"))


def latest_predictions(preds: DataFrame) -> DataFrame:
    """Prediction rows of each model's latest version (aggregate + join, no window over a
    possibly huge model)."""
    latest = preds.groupBy("model").agg(F.max("version").alias("version"))
    return attach(preds, materialised(latest), ["model", "version"])
