"""Profiling and aggregation (PF-*). Every multi-column profile is ONE aggregation job."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions.columns import (
    all_of, is_float_type, is_infinite, is_missing, is_numeric_type, present,
)
from tabulon.operators.outliers import fence_pair
from tabulon.operators.quantiles import quantile_values
from tabulon.plans.lookup import materialised
from tabulon.plans.multicolumn import MAX_AGGREGATES, one_row, per_column_agg
from tabulon.session import scratch_path


def infinite_counts(df: DataFrame, cols: list[str] | None = None,
                    only_nonzero: bool = True) -> DataFrame:
    """(column, n_infinite) for float/double columns with +/-Inf values."""
    cols = cols or [f.name for f in df.schema.fields if is_float_type(f.dataType)]
    out = per_column_agg(df, cols, {"n_infinite": lambda c: F.count_if(is_infinite(c))},
                         {"n_infinite": "long"})
    return out.filter(F.col("n_infinite") > 0) if only_nonzero else out


def missing_columns(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, n_missing, kind) for columns holding NULL (or NaN); kind numeric/categorical."""
    cols = cols or df.columns
    out = per_column_agg(df, cols, {"n_missing": lambda c: F.count_if(is_missing(df, c))},
                         {"n_missing": "long"})
    kinds = F.create_map(*[x for c in cols for x in (
        F.lit(c), F.lit("numeric" if is_numeric_type(df.schema[c].dataType) else "categorical"))])
    return out.filter(F.col("n_missing") > 0).withColumn("kind", kinds[F.col("column")])


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, n_null): NULL only, NaN is a value here."""
    cols = cols or df.columns
    return per_column_agg(df, cols, {"n_null": lambda c: F.count_if(F.col(c).isNull())},
                          {"n_null": "long"})


def class_counts(df: DataFrame, col: str, out: str = "n_rows") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out))


def class_distribution(df: DataFrame, col: str) -> DataFrame:
    """(label, n_rows, share, pct, pct_2dp). The total is a scalar subquery over the class counts, whose
    shuffle both share: the rows are read once and no window holds the classes. ``pct_2dp`` rounds half
    up on the binary value: floor(pct * 100 + 0.5) / 100."""
    counts = class_counts(df, col)
    total = counts.agg(F.sum("n_rows").cast("double")).scalar()
    pct = F.col("n_rows").cast("double") * F.lit(100.0) / total
    out = counts.select(col, "n_rows", (F.col("n_rows").cast("double") / total).alias("share"),
                        pct.alias("pct"))
    return out.withColumn("pct_2dp", F.floor(F.col("pct") * F.lit(100.0) + F.lit(0.5))
                          .cast("double") / F.lit(100.0))


def frequency_table(df: DataFrame, col: str) -> DataFrame:
    """(value, n_rows, frequency = n_rows / N); NULL is a group. N is the sum of the written
    counts, so the rows are read once."""
    counts = materialised(class_counts(df, col))
    total = counts.agg(F.sum("n_rows")).first()[0] or 0
    return counts.withColumn("frequency", F.col("n_rows").cast("double") / F.lit(float(total)))


def quantile_table(df: DataFrame, cols: list[str], probs: list[float],
                   method: str = "linear", rel_err: float = 1e-4) -> DataFrame:
    from tabulon.operators.quantiles import quantiles

    return quantiles(df, cols, probs, method, rel_err)


def box_stats(df: DataFrame, cols: list[str], k: float = 1.5) -> DataFrame:
    """(column, q1, median, q3, whisker_lo, whisker_hi, n_fliers): exact quartiles, then ONE
    aggregation for whiskers (furthest points inside the fences) and flier counts. NULL and NaN
    are no points."""
    q = quantile_values(df, cols, [0.25, 0.5, 0.75], "linear")
    stats = {}
    for c in cols:
        q1, q3 = q[(c, 0.25)], q[(c, 0.75)]
        lo, hi = fence_pair(q1, q3, k) if q1 is not None else (None, None)
        stats[c] = (q1, q[(c, 0.5)], q3, lo, hi)

    def inside(c):
        lo, hi = stats[c][3], stats[c][4]
        return (present(df, c) >= F.lit(lo)) & (present(df, c) <= F.lit(hi))

    out = per_column_agg(df, cols, {
        "whisker_lo": lambda c: F.min(F.when(inside(c), F.col(c).cast("double"))),
        "whisker_hi": lambda c: F.max(F.when(inside(c), F.col(c).cast("double"))),
        "n_fliers": lambda c: F.count_if((present(df, c) < F.lit(stats[c][3]))
                                         | (present(df, c) > F.lit(stats[c][4]))),
    }, {"whisker_lo": "double", "whisker_hi": "double", "n_fliers": "long"})
    lit_map = lambda i: F.create_map(*[x for c in cols for x in (
        F.lit(c), F.lit(stats[c][i]).cast("double"))])
    return out.select("column", lit_map(0)[F.col("column")].alias("q1"),
                      lit_map(1)[F.col("column")].alias("median"),
                      lit_map(2)[F.col("column")].alias("q3"),
                      "whisker_lo", "whisker_hi", "n_fliers")


def histogram_by(df: DataFrame, col: str, by: str, bins: int = 50) -> DataFrame:
    """Stacked histogram: ``bins`` equal bins on the global finite [min, max] (last bin closed),
    counted per ``by`` value. A constant column puts everything in bin 0. NaN and infinite values
    are counted in a row of their own with bin NULL; NULL is not counted."""
    x = F.col(col).cast("double")
    finite = F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)
    mm = one_row(df, {"lo": F.min(finite), "hi": F.max(finite)})
    lo, hi = mm["lo"], mm["hi"]
    if lo is None or hi == lo:
        b = F.when(finite.isNotNull(), F.lit(0))
        lo, width = lo or 0.0, 0.0
    else:
        half = 1.0 if math.isfinite(hi - lo) else 2.0  # the range may exceed the largest double
        width = hi / half - lo / half
        place = F.floor((finite / half - F.lit(lo / half)) / F.lit(width) * F.lit(float(bins)))
        b = F.when(finite.isNotNull(), F.least(place, F.lit(bins - 1))).cast("int")
        width *= half
    counted = (df.filter(F.col(col).isNotNull()).groupBy(by, b.alias("bin"))
               .agg(F.count(F.lit(1)).alias("n_rows")))
    lo_edge = F.lit(lo) + F.lit(width) * F.col("bin").cast("double") / F.lit(float(bins))
    return counted.withColumn("bin_lo", lo_edge)


#: A variance below this share of the second moment is rounding: the side counts as constant.
CONSTANT = 1e-12
#: Columns of a tile of the correlation matrix.
TILE = 128


def _correlation(n, cross, s_a, s_b, ss_a, ss_b):
    """Pearson correlations from the sums over complete pairs; NaN where there is none, or a side is
    constant."""
    with np.errstate(divide="ignore", invalid="ignore"):
        va, vb = ss_a - s_a ** 2 / n, ss_b - s_b ** 2 / n
        found = (cross - s_a * s_b / n) / np.sqrt(va * vb)
    return np.where((n > 0) & (va > CONSTANT * ss_a) & (vb > CONSTANT * ss_b), found, np.nan)


def _shifts(df: DataFrame, cols: list[str]) -> tuple[dict[str, float], int]:
    """What is taken off each column's values: its mean, its only value, 0 if that is not finite; and
    the number of rows."""
    out, n_rows = {}, 0
    for at in range(0, len(cols), MAX_AGGREGATES // 3):
        some = cols[at:at + MAX_AGGREGATES // 3]
        row = one_row(df, {"rows": F.count(F.lit(1))} | {
            f"{k}{i}": f(present(df, c)) for i, c in enumerate(some) for k, f in (("lo", F.min), ("hi", F.max), ("mean", F.avg))})
        n_rows = row["rows"]
        for i, c in enumerate(some):
            s = row[f"lo{i}"] if row[f"lo{i}"] == row[f"hi{i}"] else row[f"mean{i}"]
            out[c] = s if s is not None and math.isfinite(s) else 0.0
    return out, n_rows


def _tile(df: DataFrame, left: list[str], right: list[str], shift: dict[str, float]) -> np.ndarray:
    """Pairwise-complete correlations of the columns ``left`` x ``right``, NaN where undefined. All
    sums are blocks of one Gramian over the vectors (present, x, x squared), x = 0 where missing and
    shifted; the scan reads the tile's columns only."""
    cols = list(dict.fromkeys([*left, *right]))
    values = [present(df, c) for c in cols]
    moved = [F.coalesce(v - F.lit(shift[c]), F.lit(0.0)) for v, c in zip(values, cols)]
    vector = array_to_vector(F.array(*[v.isNotNull().cast("double") for v in values], *moved,
                                     *[m * m for m in moved])).alias("v")
    k = len(cols)
    g = RowMatrix(MLUtils.convertVectorColumnsFromML(df.select(vector), "v"), 0, 3 * k).computeGramianMatrix().toArray()
    a, b = ([cols.index(c) for c in side] for side in (left, right))
    n, s, ss, cross = g[:k, :k], g[k:2 * k, :k], g[2 * k:, :k], g[k:2 * k, k:2 * k]
    here = np.ix_(a, b)
    return _correlation(n[here], cross[here], s[here], s.T[here], ss[here], ss.T[here])


def correlation_matrix(df: DataFrame, cols: list[str], tile: int = TILE) -> DataFrame:
    """(col_a, col_b, corr) for every ordered pair of columns: pairwise-complete Pearson correlations
    (NULL and NaN missing; NULL where a side is constant or a pair has no complete row).

    One job for the means, then one for each pair of tiles of ``tile`` columns; the driver holds the
    sums of one pair of tiles, and with more than one tile the results are written pair by pair."""
    schema = "col_a string, col_b string, corr double"
    spark, (shift, n_rows) = df.sparkSession, _shifts(df, cols)
    tiles = [cols[at:at + tile] for at in range(0, len(cols), tile)]
    path = scratch_path(spark, "correlations") if len(tiles) > 1 else None
    rows: list = []
    for i, left in enumerate(tiles):
        for right in tiles[i:]:
            found = _tile(df, left, right, shift) if n_rows else np.full((len(left), len(right)), np.nan)
            rows = [(a, b, None if math.isnan(v) else v) for a, line in zip(left, found.tolist()) for b, v in zip(right, line)]
            if right is not left:
                rows += [(b, a, v) for a, b, v in rows]
            if path:
                spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path) if path else spark.createDataFrame(rows, schema)


def target_correlation(df: DataFrame, target: str, cols: list[str]) -> DataFrame:
    """(column, corr) of each feature with the target; undefined ones dropped, ascending, target
    itself removed. One aggregation of the sums of every (feature, target) pair, stable around their
    means."""
    y = present(df, target)

    def regr(name):
        return lambda c: F.call_function(f"regr_{name}", y, present(df, c))

    names = ("sxy", "sxx", "syy", "count", "avgx", "avgy")
    sums = per_column_agg(df, [c for c in cols if c != target], {k: regr(k) for k in names}, {"count": "long"})
    varies = [F.col(v) > F.lit(CONSTANT) * (F.col(v) + F.col("count") * F.col(m) * F.col(m))
              for v, m in (("sxx", "avgx"), ("syy", "avgy"))]
    corr = F.when(all_of(varies), F.try_divide(F.col("sxy"), F.sqrt(F.col("sxx")) * F.sqrt(F.col("syy"))))
    out = sums.select("column", corr.alias("corr"))
    return out.filter(F.col("corr").isNotNull() & ~F.isnan("corr")).orderBy("corr", "column")


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, n_rows) of same-typed columns, NULL a value: one aggregation, no Expand."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in cols])
    return (df.select(F.inline(pairs)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n_rows")))


def by_type(df: DataFrame, cols: list[str]) -> list[list[str]]:
    """Columns grouped by data type, so that each group unpivots into one value column."""
    groups: dict[str, list[str]] = {}
    for c in cols:
        groups.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    return list(groups.values())


def high_cardinality(df: DataFrame, cols: list[str], threshold: int = 100) -> DataFrame:
    """(column, n_groups, is_high): exact number of groups (NULL counts as one) vs threshold, from
    the (column, value) counts."""
    out = None
    for group in by_type(df, cols):
        part = value_counts(df, group).groupBy("column").agg(F.count(F.lit(1)).alias("n_groups"))
        out = part if out is None else out.unionByName(part)
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    counted = names.join(out, "column", "left").withColumn("n_groups", F.coalesce("n_groups", F.lit(0)))
    return counted.withColumn("is_high", F.col("n_groups") > F.lit(threshold))


def min_positive_score(df: DataFrame, prediction: str = "prediction", score: str = "score",
                       by: list[str] | None = None) -> DataFrame:
    """Smallest score among rows predicted positive (per ``by`` group)."""
    expr = F.min(F.when(F.col(prediction) == 1, F.col(score))).alias("min_positive_score")
    return df.groupBy(*(by or [])).agg(expr)
