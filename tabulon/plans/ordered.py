"""Distributed ordered scans: prefix sums, forward fill, following rows and global ranks.

A window with an ORDER BY but no (or a hot) PARTITION BY runs in a single task. These helpers
instead range-partition the rows on (keys, order), number the resulting chunks, scan every chunk by
itself and write the rows with the result, all in one job: the chunk numbers are stored with the
rows, so they are the same for all that reads them. What a chunk hands to the next ones is one small
row per key and chunk; it is read off the written table, written too, and attached as a lookup of
measured size, so the rows are not moved again. No task ever holds more than one chunk, however many
rows one key has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.plans.lookup import attach, materialised

CHUNK = "_chunk"


def _order_cols(order: list[tuple[str, bool]]) -> list[Column]:
    """``order`` is a list of (column, descending)."""
    return [F.col(c).desc() if desc else F.col(c).asc() for c, desc in order]


def _chunks(df: DataFrame, keys: list[str], order: list[Column], num_chunks: int | None) -> DataFrame:
    """Rows range-partitioned on (keys, order) with their chunk number, monotone in both. Without
    ``num_chunks`` the range shuffle uses the session's shuffle partitions and AQE coalesces adjacent
    ranges to its advisory size; coalescing keeps ranges contiguous."""
    cols = [*[F.col(k).asc() for k in keys], *order]
    ranged = df.repartitionByRange(num_chunks, *cols) if num_chunks else df.repartitionByRange(*cols)
    return ranged.withColumn(CHUNK, F.spark_partition_id())


def _carried(part: DataFrame, keys: list[str], carries: DataFrame) -> DataFrame:
    """The written rows with the columns of ``carries`` (keys, chunk, ...) of their key and chunk."""
    return attach(part, materialised(carries), [*keys, CHUNK])


def running_sums(df: DataFrame, keys: list[str], order: list[tuple[str, bool]],
                 sum_cols: list[str], suffix: str = "_cum", totals: bool = False,
                 num_chunks: int | None = None, following: tuple[str, ...] = ()) -> DataFrame:
    """Inclusive running sums of ``sum_cols`` per ``keys`` in ``order`` (order must be unique
    within a key). Adds ``<col><suffix>`` columns; with ``totals`` also ``<col>_total`` (the per-key
    sum); for the columns ``following`` also ``next_<col>``, their value on the key's following row
    (NULL on its last one)."""
    cols = _order_cols(order)
    rows = Window.partitionBy(*keys, CHUNK).orderBy(*cols)
    upto = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    part = materialised(_chunks(df, keys, cols, num_chunks).select(
        *df.columns, CHUNK, *[F.sum(c).over(upto).alias(f"_in_{c}") for c in sum_cols],
        *[F.lead(c).over(rows).alias(f"_lead_{c}") for c in following],
        *([F.row_number().over(rows).alias("_nth")] if following else [])))
    firsts = [F.min(F.when(F.col("_nth") == 1, F.struct(*following))).alias("_first")] if following else []
    per_chunk = part.groupBy(*keys, CHUNK).agg(*[F.sum(c).alias(c) for c in sum_cols], *firsts)
    chunks = Window.partitionBy(*keys).orderBy(CHUNK)
    before, whole = chunks.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*keys)
    carries = per_chunk.select(
        *keys, CHUNK, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_off_{c}") for c in sum_cols],
        *([F.sum(c).over(whole).alias(f"{c}_total") for c in sum_cols] if totals else []),
        *([F.lead("_first").over(chunks).alias("_next")] if following else []))
    return _carried(part, keys, carries).select(
        *df.columns, *[(F.col(f"_in_{c}") + F.col(f"_off_{c}")).alias(f"{c}{suffix}") for c in sum_cols],
        *([f"{c}_total" for c in sum_cols] if totals else []),
        *[F.coalesce(f"_lead_{c}", F.col("_next")[c]).alias(f"next_{c}") for c in following])


def global_row_index(df: DataFrame, order: list[tuple[str, bool]], out: str = "row_index",
                     keys: list[str] | None = None, num_chunks: int | None = None) -> DataFrame:
    """0-based position of each row in ``order`` (per ``keys``), computed without a
    single-partition window."""
    keys = keys or []
    with_one = df.withColumn("_one", F.lit(1).cast("long"))
    out_df = running_sums(with_one, keys, order, ["_one"], num_chunks=num_chunks)
    return out_df.withColumn(out, F.col("_one_cum") - 1).drop("_one", "_one_cum")


def forward_fill(df: DataFrame, cols: list[str], order: str, keys: list[str] | None = None,
                 num_chunks: int | None = None, ties: list[str] | None = None) -> DataFrame:
    """Replace NULLs in ``cols`` by the last non-null value before them in ``order`` (per ``keys``).
    Rows before the first non-null stay NULL.

    Rows of one key and order value are ordered by ``ties`` (default: all other columns, as they are
    listed), ascending, NULLs last, so the result does not depend on where rows lie: rows that agree
    in all of them are alike. Equal rows are cut into chunks like others, by their place."""
    keys = keys or []
    ties = [c for c in df.columns if c not in (*keys, order)] if ties is None else ties
    cols_in_order = [F.col(order).asc(), *[F.col(c).asc_nulls_last() for c in ties], F.col("_place").asc()]
    rows = Window.partitionBy(*keys, CHUNK).orderBy(*cols_in_order)
    upto = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tagged = _chunks(df.withColumn("_place", F.monotonically_increasing_id()), keys, cols_in_order, num_chunks)
    part = materialised(tagged.select(
        *[F.last(c, ignorenulls=True).over(upto).alias(c) if c in cols else F.col(c) for c in df.columns],
        CHUNK, F.lead(F.lit(1)).over(rows).isNull().alias("_end")))
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carries = part.filter("_end").select(*keys, CHUNK, *[
        F.last(c, ignorenulls=True).over(before).alias(f"_carry_{c}") for c in cols])
    return _carried(part, keys, carries).select(
        *[F.coalesce(c, f"_carry_{c}").alias(c) if c in cols else F.col(c) for c in df.columns])
