"""

Every entry takes (spark, sf_dir) and returns a DataFrame over the WHOLE input tables.
``tabulon.plans.oracle`` holds the matching SQL for each key that has one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.operators import clean
from tabulon.operators import evaluate as ev
from tabulon.operators import features as fe
from tabulon.operators import leaderboard as lb
from tabulon.operators import models, outliers, preprocess, profile, scoring, split
from tabulon.operators.frequency import FrequencyEncoder, FrequencyEncoderModel
from tabulon.operators import quantiles as quantile_ops
from tabulon.plans import bindings as B
from tabulon.plans import lookup
from tabulon.session import scratch_path
from tabulon.sources import files, metrics_store
from tabulon.sources import models as model_io

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PREDS_BY = ["model", "version", "dataset"]
SKEW_COLS = ["value", "user_id"]


def query(name: str):
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        return fn
    return register


def r9(c) -> F.Column:
    """Round a floating result of a sum/average to 9 decimals, so that summation order (which
    differs between engines and partitionings) does not show in comparisons."""
    return F.round(F.col(c) if isinstance(c, str) else c, 9)


# ---------------------------------------------------------------- flagship
@query("flagship_iqr_lang_share")
def flagship(spark, d):
    """documents -> exact quartiles of n_chars -> IQR filter -> count and share per lang."""
    docs = B.table(spark, d, "documents").select("lang", "n_chars")
    kept = outliers.remove_outliers(docs, ["n_chars"])
    return profile.class_distribution(kept, "lang")


# ---------------------------------------------------------------- sources and sinks (IO-*)
@query("io_csv_roundtrip")
def io_csv_roundtrip(spark, d):
    path = scratch_path(spark, "nation_csv")
    files.write_delimited(B.table(spark, d, "nation"), path, sep=";")
    back = files.read_delimited(spark, path, types={"n_nationkey": "int", "n_regionkey": "int"},
                                sep=";")
    return back.select("n_nationkey", "n_name", "n_regionkey")


@query("io_parquet_project")
def io_parquet_project(spark, d):
    return files.read_table(spark, f"{d}/lineitem.parquet", ["l_orderkey", "l_quantity"])


@query("io_parquet_roundtrip")
def io_parquet_roundtrip(spark, d):
    path = scratch_path(spark, "cls3")
    files.write_table(B.cls3(spark, d), path, mode="overwrite")
    return files.read_table(spark, path)


@query("model_roundtrip_scores")
def model_roundtrip_scores(spark, d):
    """Only an invariant is compared: no row's score changes by saving and loading a model."""
    df = B.train_sep(spark, d)
    model = models.train(df, "logistic", "Target0", B.CLS3_FEATURES, params={"maxIter": 20})
    path = scratch_path(spark, "model_lr")
    model_io.save_model(model, path)
    first = scoring.positive_score(model.transform(df), out="before").select(*df.columns, "before")
    both = scoring.positive_score(model_io.load_model(path).transform(first), out="after")
    return both.agg(F.count(F.lit(1)).alias("n_rows"),
                    F.count_if(F.col("before") != F.col("after")).alias("n_differing"))


def _evaluated(spark, d):
    return ev.evaluate(B.predictions(spark, d), by=PREDS_BY)


@query("metrics_long")
def metrics_long(spark, d):
    """A run that is logged twice, as after a failure, leaves its rows once."""
    path = scratch_path(spark, "metrics")
    found = lookup.materialised(_evaluated(spark, d))
    for _ in range(2):
        metrics_store.log_metrics(found, path, "evaluation")
    back = metrics_store.read_metrics(spark, path)
    return back.select(*PREDS_BY, "metric", r9("value").alias("value"))


@query("metrics_wide")
def metrics_wide(spark, d):
    wide = metrics_store.metrics_for(_evaluated(spark, d))
    return wide.select(*PREDS_BY, *[r9(m).alias(m) for m in metrics_store.METRIC_NAMES])


@query("latest_version")
def latest_version(spark, d):
    return metrics_store.latest_predictions(B.predictions(spark, d))


@query("model_versions")
def model_versions(spark, d):
    return metrics_store.model_versions(B.predictions(spark, d))


# ---------------------------------------------------------------- projection, casts (CL-*)
@query("cast_columns")
def cast_columns(spark, d):
    df = clean.cast_columns(B.dirty(spark, d), {"raw": "double", "user_id": "int"})
    return df.select("event_id", "raw", "user_id")


@query("project_columns")
def project_columns(spark, d):
    return clean.project(B.cls3(spark, d), ["Target", "l_quantity"])


@query("drop_columns")
def drop_columns(spark, d):
    return clean.drop_columns(B.cls3(spark, d), ["l_discount", "l_tax"])


@query("rename_columns")
def rename_columns(spark, d):
    df = clean.rename(B.cls3(spark, d), {"Target": "label", "l_quantity": "quantity"})
    return df.select("label", "quantity")


@query("table_shape")
def table_shape(spark, d):
    return clean.shape(B.cls3(spark, d))


@query("tail_rows")
def tail_rows(spark, d):
    orders = B.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return clean.tail_rows(orders, 10, ["o_orderkey"])


@query("head_rows")
def head_rows(spark, d):
    orders = B.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return clean.head_rows(orders, 10, ["o_orderkey"])


@query("distinct_labels")
def distinct_labels(spark, d):
    return clean.distinct_values(B.cls3(spark, d), "Target")


@query("missing_rows")
def missing_rows(spark, d):
    df = B.dirty(spark, d)
    flags = clean.missing_flags(df, ["value", "raw"])
    out = df.select("event_id", flags["value"].alias("value_missing"),
                    flags["raw"].alias("raw_missing"))
    return out.filter(F.col("value_missing") | F.col("raw_missing"))


@query("fill_missing")
def fill_missing(spark, d):
    return clean.fill_missing(B.dirty(spark, d), ["value"], 0).select("event_id", "value")


@query("filter_equals")
def filter_equals(spark, d):
    li = B.table(spark, d, "lineitem")
    return clean.filter_equals(li, "l_returnflag", "R").select("l_orderkey", "l_linenumber",
                                                               "l_quantity")


def _flagged_events(spark, d):
    events = B.table(spark, d, "events").select("event_id", *SKEW_COLS)
    return outliers.flag_outliers(events, SKEW_COLS)


@query("rows_any_outlier")
def rows_any_outlier(spark, d):
    flagged = _flagged_events(spark, d)
    return clean.rows_with_any(flagged, [f"{c}_is_outlier" for c in SKEW_COLS]).select("event_id")


@query("rows_no_outlier")
def rows_no_outlier(spark, d):
    flagged = _flagged_events(spark, d)
    return clean.rows_with_none(flagged, [f"{c}_is_outlier" for c in SKEW_COLS]).select("event_id")


@query("case_label")
def case_label(spark, d):
    df = clean.label_case(B.binary_scores(spark, d), "prediction", {1: "Buy"}, "Do not buy",
                          "decision")
    return df.select("row_id", "decision")


# ---------------------------------------------------------------- joins (JN-*)
@query("join_frequency_left")
def join_frequency_left(spark, d):
    df = B.cats(spark, d)
    out = fe.join_frequency(df, fe.frequency_lookup(df, "user_key"), "user_key",
                            "user_key_frequency")
    return out.select("event_id", "user_key", "user_key_frequency")


@query("join_class_counts")
def join_class_counts(spark, d):
    df = B.cls3(spark, d)
    counts = lookup.materialised(profile.class_counts(df, "Target", "n_class"))
    return lookup.attach(df, counts, ["Target"], null_safe=False).select("Target", "l_quantity", "n_class")


# ---------------------------------------------------------------- profiling (PF-*)
@query("infinite_counts")
def infinite_counts(spark, d):
    return profile.infinite_counts(B.dirty(spark, d))


@query("missing_columns")
def missing_columns(spark, d):
    return profile.missing_columns(B.dirty(spark, d))


@query("null_counts")
def null_counts(spark, d):
    return profile.null_counts(B.dirty(spark, d))


@query("class_counts")
def class_counts(spark, d):
    return profile.class_counts(B.cls3(spark, d), "Target")


@query("class_distribution")
def class_distribution(spark, d):
    return profile.class_distribution(B.cls3(spark, d), "Target")


@query("quantiles_exact")
def quantiles_exact(spark, d):
    q = profile.quantile_table(B.cls3(spark, d), B.CLS3_FEATURES, [0.25, 0.5, 0.75], "linear")
    return q.select("column", "prob", r9("value").alias("value"))


@query("quantiles_disc")
def quantiles_disc(spark, d):
    return profile.quantile_table(B.cls3(spark, d), B.CLS3_FEATURES, [0.1, 0.25, 0.5, 0.75, 0.9],
                                  "lower")


@query("quantiles_skew")
def quantiles_skew(spark, d):
    docs = B.table(spark, d, "documents").select("n_chars")
    q = profile.quantile_table(docs, ["n_chars"], [0.01, 0.25, 0.5, 0.75, 0.99], "linear")
    return q.select("column", "prob", r9("value").alias("value"))


@query("quantiles_approx")
def quantiles_approx(spark, d):
    """Greenwald-Khanna sketch, one pass for all columns. Only an invariant is compared: the value's
    ranks enclose the wanted rank within the error."""
    df, probs, err = B.cls3(spark, d), [0.25, 0.5, 0.75], 1e-3
    rows = profile.quantile_table(df, B.CLS3_FEATURES, probs, "approx", rel_err=err).collect()
    n = F.count(F.lit(1))
    checks = [F.struct(F.lit(r["column"]).alias("column"), F.lit(r["prob"]).alias("prob"),
                       F.col(f"ok{i}").alias("within_error")) for i, r in enumerate(rows)]
    within = df.agg(*[((F.count_if(F.col(r["column"]) < F.lit(r["value"])) <= n * (r["prob"] + err) + 1)
                       & (F.count_if(F.col(r["column"]) <= F.lit(r["value"])) >= n * (r["prob"] - err) - 1)
                       ).alias(f"ok{i}") for i, r in enumerate(rows)])
    return within.select(F.inline(F.array(*checks)))


@query("quantiles_bigint")
def quantiles_bigint(spark, d):
    """Exact quantiles of ids beyond 2^53, where doubles skip whole numbers."""
    events = B.table(spark, d, "events").select((F.col("event_id") + F.lit(2 ** 53)).alias("id"))
    return quantile_ops.integral_quantiles(events, ["id"], [0.1, 0.25, 0.5, 0.75, 0.9])


@query("quantiles_inf")
def quantiles_inf(spark, d):
    """Order statistics of a column with NULL, NaN and both infinities."""
    return profile.quantile_table(B.dirty(spark, d).select("value"), ["value"], [0.0, 0.05, 0.25, 0.5, 0.75, 1.0], "lower")


@query("box_stats")
def box_stats(spark, d):
    events = B.table(spark, d, "events").select(*SKEW_COLS)
    b = profile.box_stats(events, SKEW_COLS)
    return b.select("column", *[r9(c).alias(c) for c in ("q1", "median", "q3")],
                    "whisker_lo", "whisker_hi", "n_fliers")


@query("outlier_counts")
def outlier_counts(spark, d):
    events = B.table(spark, d, "events").select(*SKEW_COLS)
    return outliers.outlier_counts(events, SKEW_COLS)


@query("outlier_recheck")
def outlier_recheck(spark, d):
    events = B.table(spark, d, "events").select(*SKEW_COLS)
    return outliers.recheck_outliers(events, SKEW_COLS)


@query("histogram_by_class")
def histogram_by_class(spark, d):
    h = profile.histogram_by(B.cls3(spark, d), "l_extendedprice", "Target", bins=50)
    return h.select("Target", "bin", "n_rows", r9("bin_lo").alias("bin_lo"))


@query("correlation_matrix")
def correlation_matrix(spark, d):
    m = profile.correlation_matrix(B.cls3(spark, d), ["Target", *B.CLS3_FEATURES])
    return m.select("col_a", "col_b", r9("corr").alias("corr"))


@query("correlation_dirty")
def correlation_dirty(spark, d):
    """Pairwise-complete correlations: NULL and NaN are missing (the table has no infinities)."""
    m = profile.correlation_matrix(B.dirty_finite(spark, d), ["value", "user_id", "event_id"])
    return m.select("col_a", "col_b", F.round("corr", 6).alias("corr"))


@query("histogram_dirty")
def histogram_dirty(spark, d):
    h = profile.histogram_by(B.dirty(spark, d), "value", "event_type", bins=20)
    return h.select("event_type", "bin", "n_rows", r9("bin_lo").alias("bin_lo"))


@query("box_stats_dirty")
def box_stats_dirty(spark, d):
    b = profile.box_stats(B.dirty_finite(spark, d), ["value"])
    return b.select("column", *[r9(c).alias(c) for c in ("q1", "median", "q3")],
                    "whisker_lo", "whisker_hi", "n_fliers")


@query("target_correlation")
def target_correlation(spark, d):
    t = profile.target_correlation(B.cls3(spark, d), "Target", ["Target", *B.CLS3_FEATURES])
    return t.select("column", r9("corr").alias("corr"))


@query("high_cardinality")
def high_cardinality(spark, d):
    return profile.high_cardinality(B.cats(spark, d), ["user_key", "event_type"], 100)


@query("frequency_table")
def frequency_table(spark, d):
    return profile.frequency_table(B.cats(spark, d), "event_type")


@query("min_positive_score")
def min_positive_score(spark, d):
    return profile.min_positive_score(B.predictions(spark, d), by=PREDS_BY)


# ---------------------------------------------------------------- outliers, imputation (OW-*)
@query("flag_outliers")
def flag_outliers(spark, d):
    return _flagged_events(spark, d).select("event_id", *[f"{c}_is_outlier" for c in SKEW_COLS])


@query("flag_outliers_inf")
def flag_outliers_inf(spark, d):
    """Fences of a column with infinities: values beyond the fences, NaN among them, are outliers."""
    return outliers.flag_outliers(B.dirty(spark, d).select("event_id", "value"), ["value"]).select(
        "event_id", "value_is_outlier")


@query("remove_outliers")
def remove_outliers(spark, d):
    events = B.table(spark, d, "events").select("event_id", *SKEW_COLS)
    return outliers.remove_outliers(events, SKEW_COLS).select("event_id")


@query("impute_group_max")
def impute_group_max(spark, d):
    df = B.impute_input(spark, d)
    return clean.impute_by_group(df, ["period", "grp"], "value", "max").select("event_id", "value")


@query("impute_group_mode")
def impute_group_mode(spark, d):
    df = B.impute_input(spark, d)
    return clean.impute_by_group(df, ["period", "grp"], "code", "mode").select("event_id", "code")


@query("forward_fill")
def forward_fill(spark, d):
    df = B.impute_input(spark, d).select("event_id", "grp", "value")
    return clean.forward_fill(df, ["value"], "event_id", ["grp"]).select("event_id", "value")


@query("forward_fill_global")
def forward_fill_global(spark, d):
    df = B.impute_input(spark, d).select("event_id", "value")
    return clean.forward_fill(df, ["value"], "event_id").select("event_id", "value")


# ---------------------------------------------------------------- features (FE-*)
@query("label_encode")
def label_encode(spark, d):
    customers = B.table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_name")
    out = fe.label_encode(customers, ["c_mktsegment", "c_name"])
    return out.select("c_custkey", "c_mktsegment", "c_name")


@query("string_index")
def string_index(spark, d):
    out = fe.index_strings(B.cats(spark, d), ["event_type", "user_key"])
    return out.select("event_id", "event_type_index", "user_key_index")


@query("frequency_encode")
def frequency_encode(spark, d):
    out, _ = fe.frequency_encode(B.cats(spark, d), ["user_key", "event_type"], threshold=100)
    return out


@query("standard_scale")
def standard_scale(spark, d):
    out = fe.standard_scale(B.cls3(spark, d), B.CLS3_FEATURES)
    return out.select("Target", *[r9(c).alias(c) for c in B.CLS3_FEATURES])


@query("minmax_scale")
def minmax_scale(spark, d):
    return fe.minmax_scale(B.cls3(spark, d), B.CLS3_FEATURES).select("Target", *B.CLS3_FEATURES)


@query("standard_scale_dirty")
def standard_scale_dirty(spark, d):
    out = fe.standard_scale(B.dirty_finite(spark, d), ["value"])
    return out.select("event_id", r9("value").alias("value"))


@query("minmax_scale_dirty")
def minmax_scale_dirty(spark, d):
    return fe.minmax_scale(B.dirty_finite(spark, d), ["value"]).select("event_id", "value")


@query("label_encode_new_rows")
def label_encode_new_rows(spark, d):
    """The training dictionary applied to the other part: unseen values get NULL."""
    df = split.hash_split(B.table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"),
                          "c_custkey", [0.8, 0.2], names=("train", "batch"))
    fitted = fe.label_fit(df.filter(F.col("split") == "train"), ["c_mktsegment", "c_name"])
    return fe.label_transform(df.filter(F.col("split") == "batch"), fitted).select("c_custkey", "c_mktsegment", "c_name")


@query("assemble_vector")
def assemble_vector(spark, d):
    v = fe.assemble(B.cls3(spark, d), B.CLS3_FEATURES, "features")
    return fe.unfold_vector(v, "features", len(B.CLS3_FEATURES), keep=["Target"])


def _feature_chain(spark, d, ids):
    df = B.binary_real(spark, d)
    if not ids:
        df = df.drop("doc_id")
    # threshold 10: the 20-valued source is frequency-encoded, the 4-valued lang indexed
    pipe, encoded, inputs = fe.feature_pipeline(df, "quality", threshold=10, ids=ids)
    out = pipe.fit(encoded).transform(encoded)
    return fe.unfold_vector(out, "features", len(inputs), keep=[*ids, "quality"])


@query("feature_chain")
def feature_chain(spark, d):
    return _feature_chain(spark, d, [])


@query("feature_chain_with_id")
def feature_chain_with_id(spark, d):
    return _feature_chain(spark, d, ["doc_id"])


@query("feature_chain_new_rows")
def feature_chain_new_rows(spark, d):
    """The feature pipeline fitted on one part of the documents, saved, loaded and applied to the other
    part: frequencies, indexes and ranges are the training part's; rows with an index value that it
    did not hold are skipped, a frequency value that it did not hold has frequency 0."""
    df = split.hash_split(B.binary_real(spark, d), "doc_id", [0.5, 0.5], names=("train", "batch"))
    train = df.filter(F.col("split") == "train").drop("split")
    pipe, rows, inputs = fe.feature_pipeline(train, "quality", threshold=10, ids=["doc_id"])
    path = scratch_path(spark, "feature_pipeline")
    model_io.save_model(pipe.fit(rows), path)
    out = model_io.load_model(path).transform(df.filter(F.col("split") == "batch").drop("split"))
    return fe.unfold_vector(out, "features", len(inputs), keep=["doc_id", "quality"])


@query("frequency_encode_new_rows")
def frequency_encode_new_rows(spark, d):
    """The frequency encoder fitted on one part of the customers and applied, saved and loaded, to the
    other part: every name there is new, segments are known and NULL ones a value like others."""
    segment = F.when(F.col("c_custkey") % B.IMPUTE_NULL_MOD != 0, F.col("c_mktsegment"))
    df = split.hash_split(B.table(spark, d, "customer").select("c_custkey", "c_name", segment.alias("segment")),
                          "c_custkey", [0.8, 0.2], names=("train", "batch"))
    path = scratch_path(spark, "frequency_encoder")
    FrequencyEncoder(inputCols=["c_name", "segment"]).fit(df.filter(F.col("split") == "train")).write().overwrite().save(path)
    return FrequencyEncoderModel.load(path).transform(df.filter(F.col("split") == "batch").drop("split"))


@query("preprocess_chain")
def preprocess_chain(spark, d):
    spec = preprocess.PreprocessSpec(types={"raw": "double"}, fill=["value", "raw"],
                                     outlier_cols=["value", "raw"], scale=["value", "raw"],
                                     drop=["user_id", "event_type"], features=["value", "raw"])
    out = preprocess.preprocess(B.dirty(spark, d), spec, out_path=scratch_path(spark, "preprocessed"))
    u = fe.unfold_vector(out, "features", 2, keep=["event_id"])
    return u.select("event_id", r9("f0").alias("f0"), r9("f1").alias("f1"))


# ---------------------------------------------------------------- splitting (SP-*)
@query("random_split")
def random_split(spark, d):
    """Which row goes where is random; only an invariant is compared: the parts are disjoint and
    together hold every row."""
    keys = ["event_id"]
    df = B.table(spark, d, "events").select(*keys)
    out = None
    for name, part in split.random_split(df, [0.8, 0.1, 0.1], seed=42).items():
        p = part.withColumn("split", F.lit(name))
        out = p if out is None else out.unionByName(p)
    per_row = out.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_row.agg(F.sum("n").alias("n_rows"), F.count_if(F.col("n") > 1).alias("n_in_two_parts"))


@query("hash_split_small_parts")
def hash_split_small_parts(spark, d):
    return split.hash_split(B.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey",
                            [0.99, 0.005, 0.005])


@query("hash_split")
def hash_split(spark, d):
    customers = B.table(spark, d, "customer").select("c_custkey")
    return split.hash_split(customers, "c_custkey", [0.8, 0.1, 0.1])


@query("class_weights")
def class_weights(spark, d):
    out = split.class_weights(B.cls3(spark, d), "Target")
    return out.select("Target", "l_quantity", "weight")


# ---------------------------------------------------------------- training (ML-*)
# The label of TRAIN_SEP is a rule on one feature, which trees with enough bins learn without error:
# their keys are compared row by row with the rule. Logistic models are compared by invariants.
ROW_KEYS = ["l_orderkey", "l_linenumber"]
EXACT_TREE = {"maxDepth": 5, "maxBins": 64}


def _predicted(model, df, label="Target0"):
    return model.transform(df).select(*ROW_KEYS, F.col(label).cast("int").alias("label"),
                                      F.col("prediction").cast("int").alias("prediction"))


def _above_majority(scored):
    """(n_rows, above_majority): is the accuracy above the share of the most frequent label?"""
    per = scored.groupBy("label").agg(F.count(F.lit(1)).alias("n"),
                                      F.count_if(F.col("label") == F.col("prediction")).alias("right"))
    return per.agg(F.sum("n").alias("n_rows"), (F.sum("right") > F.max("n")).alias("above_majority"))


@query("train_logistic")
def train_logistic(spark, d):
    """Only an invariant is compared: the accuracy is above the majority share."""
    df = B.train_sep(spark, d)
    model = models.train(df, "logistic", "Target0", B.CLS3_FEATURES, params={"maxIter": 20, "regParam": 0.01})
    return _above_majority(_predicted(model, df))


@query("train_tree")
def train_tree(spark, d):
    df = B.train_sep(spark, d)
    return _predicted(models.train(df, "tree", "Target0", B.CLS3_FEATURES, params=EXACT_TREE), df)


@query("train_forest")
def train_forest(spark, d):
    df = B.train_sep(spark, d)
    return _predicted(models.train(df, "forest", "Target0", B.CLS3_FEATURES, params={"numTrees": 10, **EXACT_TREE}), df)


@query("train_gbt")
def train_gbt(spark, d):
    df = B.train_sep(spark, d)
    return _predicted(models.train(df, "gbt", "is_first", B.CLS3_FEATURES,
                                   params={"maxIter": 10, "maxDepth": 3, "maxBins": 64}), df, "is_first")


@query("train_gbt_ovr")
def train_gbt_ovr(spark, d):
    df = B.train_sep(spark, d)
    return _predicted(models.one_vs_rest(df, "gbt", "Target0", B.CLS3_FEATURES,
                                         params={"maxIter": 10, "maxDepth": 3, "maxBins": 64}), df)


def _best_tuned(df, families, grids, folds=0, **how):
    """The best model of the families, each tuned over its whole grid on one shared training frame;
    the first one of equals."""
    top, best = None, None
    with models.TrainingFrame.of(df, B.CLS3_FEATURES, "Target0", folds=folds) as rows:
        for family in families:
            model, scores = models.tune(None, family, "Target0", B.CLS3_FEATURES, grids[family], folds=folds, rows=rows, **how)
            if top is None or max(scores) > top:
                top, best = max(scores), model
    return best


@query("tune_cv")
def tune_cv(spark, d):
    """The whole cross-validation grids, 3 folds: 9 points for logistic regression, 9 for trees and 27
    for forests; the best model by accuracy."""
    df = B.train_sep(spark, d)
    return _predicted(_best_tuned(df, ("logistic", "tree", "forest"), models.CV_GRIDS, method="cv", folds=3), df)


@query("tune_tvs")
def tune_tvs(spark, d):
    """Train/validation split over the whole grids: 27 points for logistic regression and 18 for
    forests; the best model by accuracy."""
    df = B.train_sep(spark, d)
    return _predicted(_best_tuned(df, ("logistic", "forest"), models.TVS_GRIDS, method="tvs", ratio=0.9), df)


@query("tune_gbt_ovr")
def tune_gbt_ovr(spark, d):
    """Train/validation split of gradient-boosted trees (10 iterations) inside one-vs-rest over the
    whole grid; the grid reaches the sub-models."""
    df = B.train_sep(spark, d)
    best, _ = models.tune(df, "gbt", "Target0", B.CLS3_FEATURES, models.TVS_GRIDS["gbt"],
                          method="tvs", ratio=0.9, one_vs_rest_base=True, fixed={"maxIter": 10})
    return _predicted(best, df)


def _parts(df, names=("train", "test", "val"), weights=(0.8, 0.1, 0.1)):
    df = split.hash_split(df, "l_orderkey", list(weights), names=names)
    return {n: df.filter(F.col("split") == n) for n in names}


@query("train_suite")
def train_suite(spark, d):
    """Three families tuned over their whole grids by cross-validation on the train part and scored
    on the others, per model and part: trees make no error, the logistic model is above the majority
    share."""
    parts = _parts(B.train_sep(spark, d))
    _, preds = models.train_suite(parts["train"], {n: parts[n] for n in ("test", "val")}, models.CV_GRIDS, "Target0",
                                  B.CLS3_FEATURES, "l_orderkey", method="cv", folds=3)
    per = preds.groupBy("model", "dataset", "label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == F.col("prediction")).alias("right"))
    return per.groupBy("model", "dataset").agg(
        F.sum("n").alias("n_rows"), (F.sum("right") > F.max("n")).alias("above_majority"),
        F.when(F.col("model") != "logistic", F.sum("n") - F.sum("right")).alias("n_wrong"))


@query("train_champion")
def train_champion(spark, d):
    """Families trained with class weights of the train part only, tuned over their whole grids with 3
    folds; the champion by the metrics of the test part. Both families are without error, so the first
    one stays."""
    parts = _parts(B.train_sep(spark, d))
    weighted = split.class_weights(parts["train"], "is_first", "weight")
    families = {family: models.CV_GRIDS[family] for family in ("tree", "forest")}
    champ, _, metrics, _ = models.train_and_pick(
        weighted, {n: parts[n] for n in ("test", "val")}, families, "is_first", B.CLS3_FEATURES, "l_orderkey",
        method="cv", weight="weight", folds=3)
    return (metrics.filter(F.col("metric").isin("accuracy", "f1_score", "roc_auc"))
            .select("model", "dataset", "metric", r9("value").alias("value"), (F.col("model") == champ).alias("champion")))


@query("train_weighted")
def train_weighted(spark, d):
    """Class-weighted logistic regression on the encoded document features (id kept out). Only an
    invariant is compared: the ROC AUC on the training rows is above one half."""
    df = split.class_weights(B.binary_real(spark, d), "quality", "weight")
    pipe, encoded, _ = fe.feature_pipeline(df, "quality", threshold=100, ids=["doc_id", "weight"])
    feats = pipe.fit(encoded).transform(encoded)
    lr = LogisticRegression(featuresCol="features", labelCol="quality", weightCol="weight", maxIter=20)
    scored = scoring.positive_score(lr.fit(feats).transform(feats)).withColumn("label", F.col("quality").cast("int"))
    auc = ev.roc_auc(scored.withColumn("model", F.lit("logistic")), by=["model"])
    return auc.select(F.lit(scored.count()).cast("long").alias("n_rows"), (F.col("roc_auc") > 0.5).alias("auc_above_half"))


@query("pick_champion")
def pick_champion(spark, d):
    test = _evaluated(spark, d).filter(F.col("dataset") == "test")
    wide = metrics_store.metrics_for(test, metrics=["accuracy", "f1_score", "roc_auc"]).drop("dataset")
    champ = models.pick_champion(wide, ["model", "version"])
    return champ.select("model", "version", *[r9(c).alias(c) for c in
                                              ("accuracy", "f1_score", "roc_auc")])


# ---------------------------------------------------------------- evaluation (EV-*)
@query("prediction_nulls")
def prediction_nulls(spark, d):
    return ev.prediction_nulls(B.predictions(spark, d), by=PREDS_BY)


@query("binary_counts")
def binary_counts(spark, d):
    return ev.binary_counts(B.predictions(spark, d), by=PREDS_BY)


@query("binary_metrics")
def binary_metrics(spark, d):
    return ev.binary_metrics(B.predictions(spark, d), by=PREDS_BY)


@query("binary_metrics_nan")
def binary_metrics_nan(spark, d):
    return ev.binary_metrics_unguarded(B.predictions(spark, d), by=PREDS_BY)


@query("confusion_matrix")
def confusion_matrix(spark, d):
    return ev.confusion_matrix(B.multi_preds(spark, d), by=PREDS_BY)


@query("confusion_wide")
def confusion_wide(spark, d):
    return ev.confusion_wide(B.multi_preds(spark, d), by=PREDS_BY)


@query("per_class_metrics")
def per_class_metrics(spark, d):
    return ev.per_class_metrics(B.multi_preds(spark, d), by=PREDS_BY)


@query("classification_report")
def classification_report(spark, d):
    r = ev.classification_report(B.multi_preds(spark, d), by=PREDS_BY)
    return r.select(*PREDS_BY, "class_label", *[r9(c).alias(c) for c in
                                                ("precision", "recall", "f1_score")], "support")


@query("multiclass_metrics")
def multiclass_metrics(spark, d):
    m = ev.multiclass_metrics(B.multi_preds(spark, d), by=PREDS_BY)
    return m.select(*PREDS_BY, *[r9(c).alias(c) for c in
                                 ("accuracy", "weighted_precision", "weighted_recall", "weighted_f1")])


@query("roc_curve")
def roc_curve(spark, d):
    return ev.roc_curve(B.predictions(spark, d), by=PREDS_BY)


@query("roc_curve_dropped")
def roc_curve_dropped(spark, d):
    """ROC points without collinear intermediates (scikit-learn's default curve)."""
    return ev.roc_curve(B.predictions(spark, d), by=PREDS_BY, drop_intermediate=True)


@query("roc_auc")
def roc_auc(spark, d):
    return ev.roc_auc(B.predictions(spark, d), by=PREDS_BY)


@query("pr_curve")
def pr_curve(spark, d):
    return ev.pr_curve(B.predictions(spark, d), by=PREDS_BY)


@query("pr_auc")
def pr_auc(spark, d):
    a = ev.pr_auc(B.predictions(spark, d), by=PREDS_BY)
    return a.select(*PREDS_BY, r9("pr_auc").alias("pr_auc"))


@query("evaluate_all")
def evaluate_all(spark, d):
    return _evaluated(spark, d).select(*PREDS_BY, "metric", r9("value").alias("value"))


# ---------------------------------------------------------------- scoring, monitoring (SC-*, MO-*)
@query("batch_score")
def batch_score(spark, d):
    df = B.train_sep(spark, d)
    scored = scoring.score(models.train(df, "tree", "Target0", B.CLS3_FEATURES, params=EXACT_TREE), df)
    return scored.select(*ROW_KEYS, "Target", (F.col("prediction") + 1).cast("int").alias("prediction"))


@query("positive_score")
def positive_score(spark, d):
    bs = B.binary_scores(spark, d)
    vec = bs.select("row_id", array_to_vector(F.array(F.lit(1.0) - F.col("score"), F.col("score")))
                    .alias("probability"))
    return scoring.positive_score(vec).select("row_id", "score")


@query("score_labelled")
def score_labelled(spark, d):
    return scoring.labelled_output(B.binary_scores(spark, d), "row_id")


@query("predicted_class_counts")
def predicted_class_counts(spark, d):
    """Count per predicted class of the scored output (SC-3)."""
    return profile.class_counts(B.binary_scores(spark, d), "prediction")


@query("score_batch_prepare")
def score_batch_prepare(spark, d):
    """The preprocessing fitted on the training part, saved and loaded, applied to the batch."""
    df = split.hash_split(B.cls3(spark, d), "l_orderkey", [0.8, 0.2], names=("train", "batch"))
    path = scratch_path(spark, "fitted")
    preprocess.fit(df.filter(F.col("split") == "train"), preprocess.PreprocessSpec(scale=B.CLS3_FEATURES)).save(spark, path)
    batch = scoring.prepare_batch(df.filter(F.col("split") == "batch"), B.CLS3_FEATURES,
                                  preprocess.FittedPreprocess.load(spark, path))
    return batch.select("l_orderkey", "Target", *[r9(c).alias(c) for c in B.CLS3_FEATURES])


@query("preprocess_new_rows")
def preprocess_new_rows(spark, d):
    """Types, fills, fences and scaler fitted on one part of the rows, saved, loaded and applied to the
    other part: rows outside the training part's fences go, the rest is scaled with its statistics."""
    df = split.hash_split(B.dirty(spark, d), "event_id", [0.7, 0.3], names=("train", "batch"))
    spec = preprocess.PreprocessSpec(types={"raw": "double"}, fill=["value", "raw"], outlier_cols=["value", "raw"],
                                     scale=["value", "raw"], drop=["user_id", "event_type"], features=["value", "raw"])
    path = scratch_path(spark, "fitted")
    preprocess.fit(df.filter(F.col("split") == "train"), spec).save(spark, path)
    out = preprocess.FittedPreprocess.load(spark, path).transform(df.filter(F.col("split") == "batch"))
    u = fe.unfold_vector(out, "features", 2, keep=["event_id"])
    return u.select("event_id", r9("f0").alias("f0"), r9("f1").alias("f1"))


@query("evaluate_current")
def evaluate_current(spark, d):
    df = B.train_sep(spark, d)
    path = scratch_path(spark, "live_model")
    model_io.save_model(models.train(df, "tree", "is_first", B.CLS3_FEATURES, params=EXACT_TREE), path)
    found = scoring.evaluate_current(model_io.load_model(path), df, "is_first",
                                     {"model": "tree", "version": 1, "dataset": "all"})
    return found.select(*PREDS_BY, "metric", r9("value").alias("value"))


def _comparison(spark, d):
    """Test-set metrics of each model's earliest version (registered) vs its latest (new)."""
    test = _evaluated(spark, d).filter(F.col("dataset") == "test")
    bounds = test.groupBy("model").agg(F.min("version").alias("v_old"),
                                       F.max("version").alias("v_new"))
    tagged = test.join(bounds, "model")
    old = tagged.filter(F.col("version") == F.col("v_old")).select("model", "metric", "value")
    new = tagged.filter(F.col("version") == F.col("v_new")).select("model", "metric", "value")
    return scoring.compare_metrics(old, new, ["model"])


@query("compare_metrics")
def compare_metrics(spark, d):
    c = _comparison(spark, d)
    return c.select("model", "metric", r9("old_value").alias("old_value"),
                    r9("new_value").alias("new_value"), "improved", "note")


@query("retrain_decision")
def retrain_decision(spark, d):
    return scoring.retrain_decision(_comparison(spark, d), ["model"])


#: The family behind each registered model.
REGISTERED = {"m1": "forest", "m2": "tree", "m3": "forest"}


@query("retrain_if_needed")
def retrain_if_needed(spark, d):
    """Only the registered models whose metrics got worse are tuned again, over the whole grid of their
    family with 3 folds, as their next version, with class weights of the train part; returns the
    winner among them on the test part (none if nothing got worse). The decision table has one row per
    registered model."""
    decided = scoring.retrain_decision(_comparison(spark, d), ["model"])
    failed = [r["model"] for r in decided.filter(F.col("decision") == "retrain").orderBy("model").collect()]
    schema = "model string, version int, accuracy double, f1_score double, roc_auc double"
    if not failed:
        return spark.createDataFrame([], schema)
    latest = {r["model"]: r["v"] for r in B.predictions(spark, d).groupBy("model").agg(F.max("version").alias("v")).collect()}
    parts = _parts(B.train_sep(spark, d))
    weighted = split.class_weights(parts["train"], "is_first", "weight")
    tuned, preds = {}, None
    with models.TrainingFrame.of(weighted, B.CLS3_FEATURES, "is_first", "weight", folds=3) as rows:
        for family in dict.fromkeys(REGISTERED[name] for name in failed):  # models of a family are tuned alike
            tuned[family], _ = models.tune(None, family, "is_first", B.CLS3_FEATURES, models.CV_GRIDS[family],
                                           method="cv", folds=3, weight="weight", rows=rows)
    for name in failed:
        p = models.predictions_table(tuned[REGISTERED[name]], parts["test"], "is_first", "l_orderkey", name, latest[name] + 1, "test")
        preds = p if preds is None else preds.unionByName(p)
    wide = metrics_store.metrics_for(ev.evaluate(preds, by=PREDS_BY), metrics=["accuracy", "f1_score", "roc_auc"])
    return models.pick_champion(wide, ["model"]).select(
        "model", "version", *[r9(c).alias(c) for c in ("accuracy", "f1_score", "roc_auc")])


# ---------------------------------------------------------------- leaderboards (LB-*)
def _board(spark, d):
    b = lb.leaderboard(B.predictions(spark, d))
    return b.select("model", "version", *[r9(c).alias(c) for c in b.columns
                                          if c not in ("model", "version")])


@query("leaderboard")
def leaderboard(spark, d):
    return _board(spark, d)


@query("winner_by_accuracy")
def winner_by_accuracy(spark, d):
    return lb.winner(_board(spark, d), "test_accuracy")


def _macro(spark, d):
    m = lb.macro_board(B.predictions(spark, d))
    return m.select("model", "version", *[r9(c).alias(c) for c in
                                          ("macro_precision", "macro_recall", "macro_f1", "overall")],
                    "rank")


@query("leaderboard_macro")
def leaderboard_macro(spark, d):
    return _macro(spark, d)


@query("winner_by_macro")
def winner_by_macro(spark, d):
    return lb.winner(_macro(spark, d), "overall").drop("rank")


# ---------------------------------------------------------------- end to end (NB_PRE -> NB_TRAIN)
@query("lifecycle_leaderboard")
def lifecycle_leaderboard(spark, d):
    """The notebooks' flow on the separable lineitem table: de-outlier, z-score and write the
    preprocessed table; read it back, split 70/15/15 (train, val, test) by key hash, tune
    two families by train/validation split, score val and test, and rank them."""
    spec = preprocess.PreprocessSpec(outlier_cols=B.CLS3_FEATURES, scale=B.CLS3_FEATURES,
                                     features=B.CLS3_FEATURES)
    prepared = preprocess.preprocess(B.train_sep(spark, d), spec,
                                     out_path=scratch_path(spark, "prepared"))
    weights, names = models.SPLITS["notebook_lr_rf"]
    df = split.hash_split(prepared, "l_orderkey", weights, names=names)
    datasets = {n: df.filter(F.col("split") == n) for n in ("val", "test")}
    families = {"tree": {"maxDepth": [5], "maxBins": [32, 64]},
                "forest": {"numTrees": [10], "maxDepth": [5], "maxBins": [64]}}
    _, preds = models.train_suite(df.filter(F.col("split") == "train"), datasets, families,
                                  "Target0", B.CLS3_FEATURES, "l_orderkey", method="tvs")
    board = lb.leaderboard(preds)
    return board.select("model", "version", *[r9(c).alias(c) for c in board.columns
                                              if c not in ("model", "version")])


@query("scoring_lifecycle")
def scoring_lifecycle(spark, d):
    """The prediction notebook's flow: z-score with the training statistics, fit and save a
    model on the training part, load it, prepare the scoring batch with the SAME statistics,
    score it and label the rows."""
    parts = _parts(B.train_sep(spark, d), ("train", "batch"), (0.8, 0.2))
    stats = fe.standard_scale_fit(parts["train"], B.CLS3_FEATURES)
    model = models.train(fe.standard_scale_transform(parts["train"], stats), "tree", "is_first",
                         B.CLS3_FEATURES, params=EXACT_TREE)
    path = scratch_path(spark, "scoring_model")
    model_io.save_model(model, path)
    batch = scoring.prepare_batch(parts["batch"], B.CLS3_FEATURES, stats)
    scored = scoring.positive_score(scoring.score(model_io.load_model(path), batch))
    return scoring.labelled_output(scored, "l_orderkey")


@query("score_batch_refit")
def score_batch_refit(spark, d):
    """SC-4 with ``refit=True``: the batch is z-scored with its OWN statistics (the
    reference's behaviour, kept for parity; it skews training vs serving)."""
    df = split.hash_split(B.cls3(spark, d), "l_orderkey", [0.8, 0.2], names=("train", "batch"))
    batch = scoring.prepare_batch(df.filter(F.col("split") == "batch"), B.CLS3_FEATURES,
                                  refit=True)
    return batch.select("l_orderkey", "Target", *[r9(c).alias(c) for c in B.CLS3_FEATURES])
