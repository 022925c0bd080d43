"""Feature engineering (FE-*): encoders, scalers, vector assembly and the feature pipeline.

Encoders whose dictionary grows with the data (label codes, string indexes, frequencies) are
DataFrames joined back to the rows, never Python dicts on the driver; the codes themselves are
positions in a global order, computed with the distributed ordered scan of
``tabulon.plans.ordered`` rather than a window without PARTITION BY. Scalers need one
aggregation job for all columns; their statistics are one small row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import MinMaxScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.columns import is_missing, present
from tabulon.operators.frequency import FrequencyEncoder
from tabulon.operators.profile import by_type, frequency_table, value_counts
from tabulon.plans.lookup import attach, materialised
from tabulon.plans.multicolumn import one_row
from tabulon.plans.ordered import global_row_index


# ------------------------------------------------------------------ shared: long (column, value)
def _long_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value) rows for same-typed ``cols`` (one row per input row and column)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in cols])
    return df.select(F.inline(pairs))


@dataclass(frozen=True)
class Dictionary:
    """A written table (column, value, ...) of some columns and its number of rows for each of them."""

    columns: list[str]
    table: DataFrame
    rows: dict[str, int]

    @classmethod
    def written(cls, columns: list[str], table: DataFrame) -> Dictionary:
        table = materialised(table)
        counted = table.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per column
        return cls(columns, table, {r["column"]: r["n"] for r in counted})


def _attach_column(out: DataFrame, known: Dictionary, c: str, value_col: str, target: str, how: str) -> DataFrame:
    """Add ``target`` = ``value_col`` of the dictionary rows of column ``c``."""
    own = known.table.filter(F.col("column") == F.lit(c)).select(
        F.col("value").alias(c), F.col(value_col).alias(f"_new_{c}"))
    joined = attach(out, own, [c], how=how, null_safe=how == "left", rows=known.rows.get(c, 0))
    return joined.withColumn(target, F.col(f"_new_{c}")).drop(f"_new_{c}")


# ------------------------------------------------------------------ label encoding (FE-1)
def label_codes(df: DataFrame, cols: list[str] | str) -> DataFrame:
    """(column, value, code): code = position among the sorted distinct values of that
    column; NULL, if present, sorts last, so its code is the number of distinct non-null
    values. All same-typed columns are ranked in ONE distributed ordered scan."""
    cols = [cols] if isinstance(cols, str) else cols
    distinct = (_long_values(df, cols).distinct()
                .withColumn("_null", F.col("value").isNull()))
    ranked = global_row_index(distinct, [("_null", False), ("value", False)], out="code",
                              keys=["column"])
    return ranked.drop("_null")


def label_fit(df: DataFrame, cols: list[str]) -> list[Dictionary]:
    """The training dictionaries (column, value, code), one for each type of columns."""
    return [Dictionary.written(group, label_codes(df, group).withColumn("code", F.col("code").cast("int")))
            for group in by_type(df, cols)]


def label_transform(df: DataFrame, fitted, suffix: str = "") -> DataFrame:
    """Codes of the training dictionary for any rows; values it does not hold get NULL."""
    out = df
    for known in fitted:
        for c in known.columns:
            out = _attach_column(out, known, c, "code", f"{c}{suffix}", "left")
    return out


def label_encode(df: DataFrame, cols: list[str], suffix: str = "") -> DataFrame:
    """Replace (or add, with ``suffix``) integer codes by sorted value from 0; NULL gets the
    last code (number of distinct values). One ranking per column type, joined NULL-safely."""
    return label_transform(df, label_fit(df, cols), suffix)


# ------------------------------------------------------------------ string index (FE-2)
def string_index_table(df: DataFrame, cols: list[str] | str) -> DataFrame:
    """(column, value, index): by descending frequency, ties alphabetical (the StringIndexer
    order); NULL is not indexed. Same-typed columns share one ordered scan."""
    cols = [cols] if isinstance(cols, str) else cols
    counts = (_long_values(df, cols).filter(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("_n")))
    ranked = global_row_index(counts, [("_n", True), ("value", False)], out="index",
                              keys=["column"])
    return ranked.select("column", "value", F.col("index").cast("double").alias("index"))


def index_fit(df: DataFrame, cols: list[str]) -> list[Dictionary]:
    return [Dictionary.written(group, string_index_table(df, group)) for group in by_type(df, cols)]


def index_transform(df: DataFrame, fitted, suffix: str = "_index", how: str = "inner") -> DataFrame:
    """Indexes of the training dictionary; rows with NULL or unseen values are skipped (``inner``)
    or get NULL (``left``)."""
    out = df
    for known in fitted:
        for c in known.columns:
            out = _attach_column(out, known, c, "index", f"{c}{suffix}", how)
    return out


def index_strings(df: DataFrame, cols: list[str], suffix: str = "_index") -> DataFrame:
    """Add ``<col>_index``; rows with NULL or unseen values are skipped (inner join), as
    ``StringIndexer(handleInvalid='skip')`` does."""
    return index_transform(df, index_fit(df, cols), suffix)


# ------------------------------------------------------------------ frequency encoding (FE-3)
def frequency_lookup(df: DataFrame, col: str) -> DataFrame:
    """(value, n_rows, frequency) with NULL as its own group."""
    return frequency_table(df, col).withColumnRenamed(col, "value")


def join_frequency(df: DataFrame, lookup: DataFrame, col: str, out: str) -> DataFrame:
    """Left, NULL-safe equi-join of the rows with a frequency lookup (JN-1)."""
    return attach(df, lookup.select(F.col("value").alias(col), F.col("frequency").alias(out)), [col], how="left")


def group_counts(df: DataFrame, cols: list[str]) -> list[tuple[Dictionary, int]]:
    """Per column type the written (column, value, n_rows) counts and the number of rows. NULL is a
    group."""
    out = []
    for group in by_type(df, cols):
        counts = materialised(value_counts(df, group))
        sums = counts.groupBy("column").agg(F.count(F.lit(1)).alias("groups"), F.sum("n_rows").alias("rows")).collect()
        out.append((Dictionary(group, counts, {r["column"]: r["groups"] for r in sums}), sums[0]["rows"] if sums else 0))
    return out


def frequency_fit(df: DataFrame, cols: list[str], threshold: int = 100) -> tuple[list[str], list[Dictionary]]:
    """(columns with more than ``threshold`` groups, their dictionaries (column, value, frequency)).
    The exact group counts come from the same (column, value) counts that make the frequencies; NULL
    is a group."""
    high, fitted = [], []
    for known, total in group_counts(df, cols):
        many = [c for c in known.columns if known.rows.get(c, 0) > threshold]
        if many:
            fitted.append(Dictionary(many, known.table.filter(F.col("column").isin(many)).withColumn(
                "frequency", F.col("n_rows").cast("double") / F.lit(float(total))), known.rows))
            high += many
    return [c for c in cols if c in high], fitted


def frequency_transform(df: DataFrame, fitted, suffix: str = "_encoded") -> DataFrame:
    """Replace each fitted column by ``<col>_encoded`` from the training counts; values they do not
    hold get NULL."""
    out = df
    for known in fitted:
        for c in known.columns:
            out = _attach_column(out, known, c, "frequency", f"{c}{suffix}", "left").drop(c)
    return out


def frequency_encode(df: DataFrame, cols: list[str], threshold: int = 100,
                     suffix: str = "_encoded") -> tuple[DataFrame, list[str]]:
    """Replace each column with more than ``threshold`` groups by ``<col>_encoded`` =
    share of rows with its value. Returns (frame, encoded columns)."""
    high, fitted = frequency_fit(df, cols, threshold)
    return frequency_transform(df, fitted, suffix), high


# ------------------------------------------------------------------ scalers (FE-4, FE-5)
def standard_scale_fit(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """{col: (mean, population std)} of the values that are not missing, from ONE aggregation."""
    exprs = {}
    for i, c in enumerate(cols):
        exprs[f"m{i}"] = F.avg(present(df, c))
        exprs[f"s{i}"] = F.stddev_pop(present(df, c))
    row = one_row(df, exprs)
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)}


def standard_scale_transform(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    """z = (x - mean) / std; zero variance gives 0; NULL and NaN stay what they are."""
    def z(c):
        mean, std = stats[c]
        if mean is None:
            return F.lit(None).cast("double")
        if not std:
            return F.when(is_missing(df, c), F.col(c).cast("double")).otherwise(F.lit(0.0))
        return (F.col(c).cast("double") - F.lit(mean)) / F.lit(std)
    return df.withColumns({c: z(c) for c in stats})


def standard_scale(df: DataFrame, cols: list[str] | None = None, exclude=(),
                   keep_excluded: bool = True) -> DataFrame:
    """Z-score ``cols`` (default: every numeric column not in ``exclude``). Other columns are
    kept (``keep_excluded``) or dropped, the two behaviours of the reference."""
    if cols is None:
        cols = [f.name for f in df.schema.fields
                if isinstance(f.dataType, T.NumericType) and f.name not in exclude]
    out = standard_scale_transform(df, standard_scale_fit(df, cols))
    return out if keep_excluded else out.select(*cols)


def minmax_fit(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    exprs = {}
    for i, c in enumerate(cols):
        exprs[f"lo{i}"] = F.min(present(df, c))
        exprs[f"hi{i}"] = F.max(present(df, c))
    row = one_row(df, exprs)
    return {c: (row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(cols)}


def minmax_transform(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    """(x - min) / (max - min); a constant column gives 0.5 (as ``MinMaxScaler``)."""
    def mm(c):
        lo, hi = stats[c]
        if lo is None:
            return F.lit(None).cast("double")
        if hi == lo:
            return F.when(is_missing(df, c), F.col(c).cast("double")).otherwise(F.lit(0.5))
        return (F.col(c).cast("double") - F.lit(lo)) / F.lit(hi - lo)
    return df.withColumns({c: mm(c) for c in stats})


def minmax_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    return minmax_transform(df, minmax_fit(df, cols))


# ------------------------------------------------------------------ assembly (FE-6)
def assemble(df: DataFrame, cols: list[str], out: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid=handle_invalid).transform(df)


def unfold_vector(df: DataFrame, col: str, size: int, prefix: str = "f",
                  keep: list[str] | None = None) -> DataFrame:
    """Vector column -> ``f0..f{size-1}`` double columns (``vector_to_array``, no UDF)."""
    arr = vector_to_array(F.col(col))
    return df.select(*(keep or []), *[arr[i].alias(f"{prefix}{i}") for i in range(size)])


# ------------------------------------------------------------------ pipeline (FE-7, FE-8)
def column_roles(df: DataFrame, label: str, ids=()) -> tuple[list[str], list[str]]:
    """(numeric, categorical) from the schema: string -> categorical, rest numeric."""
    skip = {label, *ids}
    numeric = [f.name for f in df.schema.fields
               if not isinstance(f.dataType, T.StringType) and f.name not in skip]
    categorical = [f.name for f in df.schema.fields
                   if isinstance(f.dataType, T.StringType) and f.name not in skip]
    return numeric, categorical


def feature_pipeline(df: DataFrame, label: str, threshold: int = 100, ids=(),
                     features_col: str = "features", handle_invalid: str = "error", unseen: float = 0.0,
                     ) -> tuple[Pipeline, DataFrame, list[str]]:
    """Build the feature pipeline of the reference, Spark-first.

    Categoricals with more than ``threshold`` groups in ``df`` are frequency-encoded
    (``<c>_encoded``); the rest are string-indexed (skip invalid). Numerics are assembled and min-max
    scaled; the final vector is [indexes..., scaled numerics, encodings...]. ``ids`` stay out of the
    features and in the frame. Every step is a stage: the fitted Pipeline, saved and loaded, scores raw
    rows with the dictionaries and ranges of the rows that it was fitted on (``unseen``: frequency of a
    value they did not hold). Missing values in the vectors raise unless ``handle_invalid`` says
    otherwise (``skip`` or ``keep``). Returns (unfitted Pipeline, frame to fit it on, final input
    columns).
    """
    numeric, categorical = column_roles(df, label, ids)
    groups = {c: n for known, _ in group_counts(df, categorical) for c, n in known.rows.items()}
    high = [c for c in categorical if groups.get(c, 0) > threshold]
    rest = [c for c in categorical if c not in high]
    stages = [FrequencyEncoder(inputCols=high, unseen=unseen)] if high else []
    stages += [StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="skip") for c in rest]
    inputs = [f"{c}_index" for c in rest]
    if numeric:
        stages.append(VectorAssembler(inputCols=numeric, outputCol="numeric_vec",
                                      handleInvalid=handle_invalid))
        stages.append(MinMaxScaler(inputCol="numeric_vec", outputCol="numeric_scaled"))
        inputs.append("numeric_scaled")
    inputs += [f"{c}_encoded" for c in high]
    stages.append(VectorAssembler(inputCols=inputs, outputCol=features_col, handleInvalid=handle_invalid))
    return Pipeline(stages=stages), df, rest + numeric + [f"{c}_encoded" for c in high]
