"""IQR outlier fences, flags, removal and re-check (OW-1..3, PF-8)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.columns import all_of, any_of
from tabulon.operators.quantiles import quantile_values
from tabulon.plans.multicolumn import per_column_agg

FLAG_SUFFIX = "_is_outlier"


def fence_pair(q1: float, q3: float, k: float = 1.5) -> tuple[float, float]:
    """(lower, upper); an infinite quartile leaves its side open (Inf - Inf is no fence)."""
    lo, hi = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
    return (-math.inf if math.isnan(lo) else lo), (math.inf if math.isnan(hi) else hi)


def fences(df: DataFrame, cols: list[str], k: float = 1.5, method: str = "linear",
           rel_err: float = 1e-4) -> dict[str, tuple[float, float]]:
    """{column: (lower, upper)} = Q1 - k*IQR, Q3 + k*IQR; all columns in the same jobs."""
    q = quantile_values(df, cols, [0.25, 0.75], method, rel_err)
    out = {}
    for c in cols:
        q1, q3 = q[(c, 0.25)], q[(c, 0.75)]
        out[c] = (None, None) if q1 is None else fence_pair(q1, q3, k)
    return out


def _outside(c: str, lo: float, hi: float):
    """Strictly outside the fences. NULL is not an outlier; NaN sorts above every number in
    Spark, so it is one."""
    if lo is None:
        return F.lit(False)
    x = F.col(c)
    return F.coalesce((x < F.lit(lo)) | (x > F.lit(hi)), F.lit(False))


def _inside(df: DataFrame, c: str, lo: float, hi: float):
    """NOT outlier, written so Parquet receives it: ``x IS NULL OR (x >= lo AND x <= hi)``
    with literals of the column's own type (integer columns get ceil/floor of the fences,
    which is exact for integers). NaN fails ``x <= hi`` and is dropped, as its flag says."""
    if lo is None:
        return F.lit(True)
    x = F.col(c)
    dt = df.schema[c].dataType
    if isinstance(dt, T.IntegralType) and math.isfinite(lo) and math.isfinite(hi):
        lo_lit, hi_lit = F.lit(math.ceil(lo)).cast(dt), F.lit(math.floor(hi)).cast(dt)
    else:
        lo_lit, hi_lit = F.lit(lo), F.lit(hi)
    return x.isNull() | ((x >= lo_lit) & (x <= hi_lit))


def flag_outliers(df: DataFrame, cols: list[str], k: float = 1.5, method: str = "linear",
                  bounds: dict | None = None) -> DataFrame:
    """Add ``<col>_is_outlier`` 0/1 flags in ONE projection. Adding flags never filters, so
    every fence comes from the same rows."""
    bounds = bounds or fences(df, cols, k, method)
    return df.withColumns({f"{c}{FLAG_SUFFIX}": _outside(c, *bounds[c]).cast("int") for c in cols})


def remove_outliers(df: DataFrame, cols: list[str], k: float = 1.5, method: str = "linear",
                    keep_flags: bool = False, bounds: dict | None = None) -> DataFrame:
    """Keep rows inside every fence. The filter is written on the raw columns (not on derived
    flags) so Parquet receives it as pushed range predicates."""
    bounds = bounds or fences(df, cols, k, method)
    keep = all_of([_inside(df, c, *bounds[c]) for c in cols])
    out = df.filter(keep)
    return flag_outliers(out, cols, bounds=bounds) if keep_flags else out


def rows_with_outlier(df: DataFrame, cols: list[str], k: float = 1.5,
                      method: str = "linear") -> DataFrame:
    bounds = fences(df, cols, k, method)
    return df.filter(any_of([_outside(c, *bounds[c]) for c in cols]))


def outlier_counts(df: DataFrame, cols: list[str], k: float = 1.5, method: str = "linear",
                   bounds: dict | None = None) -> DataFrame:
    """(column, n_outliers): ONE aggregation for all columns."""
    bounds = bounds or fences(df, cols, k, method)
    return per_column_agg(df, cols, {"n_outliers": lambda c: F.count_if(_outside(c, *bounds[c]))},
                          {"n_outliers": "long"})


def recheck_outliers(df: DataFrame, cols: list[str], k: float = 1.5,
                     method: str = "linear") -> DataFrame:
    """Second pass: remove outliers, recompute fences on what is left and count again."""
    cleaned = remove_outliers(df, cols, k, method)
    return outlier_counts(cleaned, cols, k, method)
