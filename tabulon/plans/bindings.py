"""Input bindings of the query catalog (FIXTURES.md part C), built from the driver's tables.

Each binding is a lazy DataFrame over the whole table; ``tabulon.plans.oracle`` holds the
same definitions in SQL. Fixed values that both sides must agree on are gathered here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values of the bindings (must equal the SQL side) ----
RETURNFLAG_CLASS = {"A": 1, "N": 2, "R": 3}
CLS3_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DIRTY_NULL_MOD, DIRTY_NAN_MOD, DIRTY_POSINF_MOD, DIRTY_NEGINF_MOD = 7, 11, 13, 17
DIRTY_BADTEXT_MOD, DIRTY_NULLTEXT_MOD = 19, 23
DIRTY_BADTEXT = "not a number"
IMPUTE_NULL_MOD = 7
IMPUTE_MODE_MOD = 5
BIN_POSITIVE_SEGMENT = "BUILDING"
BIN_THRESHOLD = 0.5
# model, version, threshold, bucketed score
PREDS_MODELS = [("m1", 1, 0.4, False), ("m2", 1, 0.5, False), ("m3", 1, 0.6, False),
                ("m2", 2, 0.3, True)]
SEP_CUTS = (17.0, 34.0)  # l_quantity terciles for the separable label


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _returnflag_class() -> F.Column:
    expr = None
    for flag, cls in RETURNFLAG_CLASS.items():
        cond = F.col("l_returnflag") == F.lit(flag)
        expr = F.when(cond, F.lit(cls)) if expr is None else expr.when(cond, F.lit(cls))
    return expr.cast("int")


def cls3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as a 3-class table: Target from l_returnflag, four numeric features."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", _returnflag_class().alias("Target"),
                     *CLS3_FEATURES)


def train_sep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cls3 with a label separable by l_quantity terciles: Target 1..3, Target0 counted from 0 as
    classifiers want it, is_first for the first class."""
    q = F.col("l_quantity")
    label = (F.when(q <= F.lit(SEP_CUTS[0]), 1).when(q <= F.lit(SEP_CUTS[1]), 2).otherwise(3)
             .cast("int"))
    return (cls3(spark, sf_dir).withColumn("Target", label).withColumn("Target0", F.col("Target") - 1)
            .withColumn("is_first", (F.col("Target") == 1).cast("int")))


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with injected NULL / NaN / +Inf / -Inf values and a text copy with malformed
    and NULL entries."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    value = (F.when(eid % DIRTY_NULL_MOD == 0, F.lit(None).cast("double"))
             .when(eid % DIRTY_NAN_MOD == 0, F.lit(float("nan")))
             .when(eid % DIRTY_POSINF_MOD == 0, F.lit(float("inf")))
             .when(eid % DIRTY_NEGINF_MOD == 0, F.lit(float("-inf")))
             .otherwise(F.col("value")))
    raw = (F.when(eid % DIRTY_BADTEXT_MOD == 0, F.lit(DIRTY_BADTEXT))
           .when(eid % DIRTY_NULLTEXT_MOD == 0, F.lit(None).cast("string"))
           .otherwise(F.col("value").cast("string")))
    return ev.select("event_id", "user_id", "event_type", value.alias("value"), raw.alias("raw"))


def dirty_finite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dirty with NULL in place of the infinities; NULL and NaN stay."""
    x = F.col("value")
    infinite = F.abs(x) == F.lit(float("inf"))
    return dirty(spark, sf_dir).withColumn("value", F.when(infinite, F.lit(None).cast("double")).otherwise(x))


def impute_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with a day period, NULL values (and a NULL-able small-domain code for mode)."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    hole = eid % IMPUTE_NULL_MOD == 0
    return ev.select(
        "event_id", F.to_date("ts").alias("period"), F.col("event_type").alias("grp"), "ts",
        F.when(hole, F.lit(None).cast("double")).otherwise(F.col("value")).alias("value"),
        F.when(hole, F.lit(None).cast("long")).otherwise(F.col("user_id") % IMPUTE_MODE_MOD)
        .alias("code"))


def cats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with user_id as text (high cardinality) and event_type (low)."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", F.col("user_id").cast("string").alias("user_key"), "event_type")


def binary_scores(spark: SparkSession, sf_dir: str, bucketed: bool = False) -> DataFrame:
    """customer as a scored binary problem: label BUILDING, score from the account balance."""
    cu = table(spark, sf_dir, "customer")
    score = (F.col("c_acctbal") + F.lit(1000.0)) / F.lit(11000.0)
    if bucketed:
        score = F.floor(score * F.lit(10.0)) / F.lit(10.0)
    return cu.select(
        F.col("c_custkey").alias("row_id"),
        (F.col("c_mktsegment") == F.lit(BIN_POSITIVE_SEGMENT)).cast("int").alias("label"),
        score.alias("score"),
    ).withColumn("prediction", (F.col("score") >= F.lit(BIN_THRESHOLD)).cast("int"))


def multi_preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cls3 with a fixed-rule prediction: 1 + floor(l_quantity) % 3."""
    df = cls3(spark, sf_dir)
    pred = (F.lit(1) + F.floor(F.col("l_quantity")).cast("int") % F.lit(3)).cast("int")
    return df.select(F.lit("rule").alias("model"), F.lit(1).alias("version"),
                     F.lit("test").alias("dataset"),
                     F.col("Target").alias("label"), pred.alias("prediction"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long predictions table (model, version, dataset, row_id, label, prediction, score):
    the binary scores thresholded by several model variants, from ONE scan of customer."""
    cu = table(spark, sf_dir, "customer")
    variants = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(v).alias("version"),
                                  F.lit(t).alias("threshold"), F.lit(b).alias("bucketed"))
                         for m, v, t, b in PREDS_MODELS])
    raw = (F.col("c_acctbal") + F.lit(1000.0)) / F.lit(11000.0)
    base = cu.select(
        F.col("c_custkey").alias("row_id"),
        (F.col("c_mktsegment") == F.lit(BIN_POSITIVE_SEGMENT)).cast("int").alias("label"),
        raw.alias("raw_score"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("val")).otherwise(F.lit("test")).alias("dataset"),
        F.explode(variants).alias("v"))
    score = F.when(F.col("v.bucketed"), F.floor(F.col("raw_score") * F.lit(10.0)) / F.lit(10.0)) \
        .otherwise(F.col("raw_score"))
    return base.select(
        F.col("v.model").alias("model"), F.col("v.version").alias("version"), "dataset", "row_id",
        "label", (score >= F.col("v.threshold")).cast("int").alias("prediction"),
        score.alias("score"))


def binary_real(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels joined to documents: quality label; numeric and categorical features."""
    lb = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents")
    return lb.join(docs, "doc_id").select("doc_id", "quality", "n_chars", "lang", "source")
