"""Projection, casts, predicates, fills and group-wise imputation (CL-*, OW-4..6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions.columns import all_of, any_of, is_missing
from tabulon.plans import ordered
from tabulon.plans.lookup import attach, materialised


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Re-type columns in ONE projection; malformed values become NULL (``try_cast``), where a
    plain ``cast`` raises under ANSI mode."""
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c)
                       for c in df.columns])


def project(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols)


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*cols)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_columns) as a one-row DataFrame (one count job when collected)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.lit(len(df.columns)).cast("long").alias("n_columns"))


def head_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First n rows in a stated order (top-k: each task keeps n rows, then one merge)."""
    return df.orderBy(*[F.col(c).asc() for c in order]).limit(n)


def tail_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """Last n rows in a stated order. Physical-order ``tail`` is not deterministic."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def missing_flags(df: DataFrame, cols: list[str]) -> dict[str, Column]:
    return {c: is_missing(df, c) for c in cols}


def fill_missing(df: DataFrame, cols: list[str], value=0) -> DataFrame:
    """Replace NULL (and NaN for floating columns) in ``cols`` by a constant, one projection."""
    return df.select(*[F.when(is_missing(df, c), F.lit(value)).otherwise(F.col(c)).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


def filter_equals(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(col) == F.lit(value))


def rows_with_any(df: DataFrame, flags: list[str], value=1) -> DataFrame:
    """Rows where ANY flag equals ``value`` (the OR chain)."""
    return df.filter(any_of([F.col(f) == value for f in flags]))


def rows_with_none(df: DataFrame, flags: list[str], value=0) -> DataFrame:
    """Rows where ALL flags equal ``value`` (the AND chain)."""
    return df.filter(all_of([F.col(f) == value for f in flags]))


def label_case(df: DataFrame, col: str, mapping: dict, default, out: str) -> DataFrame:
    """Text label from a value mapping (CASE WHEN ... ELSE default)."""
    expr = None
    for k, v in mapping.items():
        expr = (F.when(F.col(col) == F.lit(k), F.lit(v)) if expr is None
                else expr.when(F.col(col) == F.lit(k), F.lit(v)))
    expr = F.lit(default) if expr is None else expr.otherwise(F.lit(default))
    return df.withColumn(out, expr)


def impute_by_group(df: DataFrame, keys: list[str], col: str, stat: str = "max") -> DataFrame:
    """Fill NULLs of ``col`` with a statistic of its group.

    ``stat='max'`` is the reference's behaviour (documented there as mode, computed as max);
    ``stat='mode'`` is the true most frequent value, ties to the smallest.

    The group statistic is an aggregation with map-side combine (``mode`` first counts
    (group, value) pairs, so a hot group is spread over many tasks by its values) and is
    joined back on the group keys: the written statistics table is broadcast when its row count
    allows it, so the rows are not shuffled. A window over the group would sort a hot group in one
    task.
    """
    present = df.filter(F.col(col).isNotNull())
    if stat == "max":
        stats = present.groupBy(*keys).agg(F.max(col).alias("_fill"))
    elif stat == "min":
        stats = present.groupBy(*keys).agg(F.min(col).alias("_fill"))
    elif stat == "mode":
        pairs = present.groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_n"))
        stats = pairs.groupBy(*keys).agg(
            F.min_by(F.col(col), F.struct((-F.col("_n")).alias("n"), F.col(col).alias("v")))
            .alias("_fill"))
    else:
        raise ValueError(f"unknown stat {stat!r}")
    joined = attach(df, materialised(stats), keys, how="left")
    return joined.select(*[F.coalesce(F.col(c), F.col("_fill")).alias(c) if c == col else F.col(c)
                           for c in df.columns])


def forward_fill(df: DataFrame, cols: list[str], order: str,
                 keys: list[str] | None = None, ties: list[str] | None = None) -> DataFrame:
    """Last non-null value so far in ``order`` per ``keys`` (distributed ordered scan); rows of one
    order value in the order of ``ties`` (default: all other columns), NULLs last."""
    return ordered.forward_fill(df, cols, order, keys, ties=ties)
