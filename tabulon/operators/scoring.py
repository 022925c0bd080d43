"""Batch scoring and model monitoring (SC-*, MO-*)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions.columns import vector_element
from tabulon.operators import evaluate as ev
from tabulon.operators.features import standard_scale_fit, standard_scale_transform
from tabulon.operators.preprocess import FittedPreprocess

# fixed values: the two decision texts
POSITIVE_TEXT, NEGATIVE_TEXT = "Buy", "Do not buy"


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df)


def positive_score(df: DataFrame, prob_col: str = "probability", index: int = 1,
                   out: str = "score") -> DataFrame:
    """Probability of the positive class as a double column (no Python UDF)."""
    return df.withColumn(out, vector_element(prob_col, index))


def labelled_output(scored: DataFrame, id_col: str, score_col: str = "score",
                    prediction: str = "prediction", text_col: str = "decision") -> DataFrame:
    """id, score, prediction and a text label: 1 -> 'Buy', else 'Do not buy'."""
    text = F.when(F.col(prediction) == 1, F.lit(POSITIVE_TEXT)).otherwise(F.lit(NEGATIVE_TEXT))
    return scored.select(id_col, score_col, F.col(prediction).cast("int").alias(prediction),
                         text.alias(text_col))


def score_labelled(model: PipelineModel, df: DataFrame, id_col: str) -> DataFrame:
    scored = positive_score(model.transform(df))
    return labelled_output(scored, id_col)


def prepare_batch(batch: DataFrame, cols: list[str], fitted: FittedPreprocess | dict | None = None,
                  refit: bool = False) -> DataFrame:
    """A scoring batch as the model was trained on its rows: through the fitted preprocessing of the
    training rows (no row is dropped), or scaled with their statistics {column: (mean, std)}.
    ``refit=True`` scales ``cols`` with statistics of the batch itself (the reference's behaviour,
    which skews train vs serve); without statistics and without ``refit`` it raises."""
    if refit:
        return standard_scale_transform(batch, standard_scale_fit(batch, cols))
    if fitted is None:
        raise ValueError("a scoring batch needs the statistics of the training rows (or refit=True)")
    if isinstance(fitted, FittedPreprocess):
        return fitted.transform(batch, remove_outliers=False)
    return standard_scale_transform(batch, {c: fitted[c] for c in cols})


def evaluate_current(model: PipelineModel, df: DataFrame, label: str, by_values: dict,
                     positive_index: int = 1) -> DataFrame:
    """Score a labelled table with the live model and return long metric rows."""
    scored = positive_score(model.transform(df), index=positive_index)
    scored = scored.withColumns({k: F.lit(v) for k, v in by_values.items()})
    scored = scored.withColumn("prediction", F.col("prediction").cast("int"))
    return ev.evaluate(scored, label, "prediction", "score", list(by_values))


def compare_metrics(old: DataFrame, new: DataFrame, keys: list[str],
                    names=("accuracy", "f1_score", "roc_auc")) -> DataFrame:
    """(keys..., metric, old_value, new_value, improved, note) for every metric of interest that
    either side has: improved = new >= old, where a new value that is missing, NULL or NaN is no
    improvement. A metric without a registered old value gets a note and NULL improved."""
    o = old.filter(F.col("metric").isin(*names)).select(*keys, "metric", F.col("value").alias("old_value"))
    n = new.filter(F.col("metric").isin(*names)).select(*keys, "metric", F.col("value").alias("new_value"))
    j = n.join(o, on=[*keys, "metric"], how="full")
    better = F.coalesce((F.col("new_value") >= F.col("old_value")) & ~F.isnan("new_value"), F.lit(False))
    return j.select(*keys, "metric", "old_value", "new_value",
                    F.when(F.col("old_value").isNotNull(), better).alias("improved"),
                    F.when(F.col("old_value").isNull(), F.lit("metric not registered before"))
                    .alias("note"))


def retrain_decision(comparison: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., decision): 'retrain' when any compared metric did not improve."""
    worse = F.bool_or(F.col("improved") == F.lit(False))
    return comparison.groupBy(*keys).agg(
        F.when(worse, F.lit("retrain")).otherwise(F.lit("keep")).alias("decision"))
