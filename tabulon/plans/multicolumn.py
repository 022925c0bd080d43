"""One aggregation job for many columns, then an in-plan unpivot to long rows.

The reference profiled columns with one Spark job per column; here every per-column
statistic is an aggregate expression of a single ``agg`` (one scan, map-side partial
aggregation) and the one-row result is turned into ``(column, stat...)`` rows with
``inline(array(struct...))`` inside the same plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


MAX_AGGREGATES = 120


def per_column_agg(df: DataFrame, cols: list[str],
                   stats: dict[str, Callable[[str], Column]],
                   types: dict[str, str] | None = None,
                   name_col: str = "column") -> DataFrame:
    """Return one row per column with one field per statistic, from ONE aggregation.

    Very wide inputs are split into batches of at most ``MAX_AGGREGATES`` aggregate
    expressions: one huge aggregation exceeds the generated-code size limit and runs
    interpreted, while each batch reads only its own Parquet columns, so batching adds no
    I/O. The batches are unioned into one plan (one job)."""
    types = types or {}
    if not cols:
        schema = ", ".join([f"{name_col} string"] + [f"{s} {types.get(s, 'double')}" for s in stats])
        return df.sparkSession.createDataFrame([], schema)
    per_batch = max(1, MAX_AGGREGATES // max(1, len(stats)))
    if len(cols) > per_batch:
        parts = [per_column_agg(df, cols[i:i + per_batch], stats, types, name_col)
                 for i in range(0, len(cols), per_batch)]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    aggs = [fn(c).alias(f"_s{si}_{ci}") for ci, c in enumerate(cols)
            for si, fn in enumerate(stats.values())]
    wide = df.agg(*aggs)
    rows = []
    for ci, c in enumerate(cols):
        fields = [F.lit(c).alias(name_col)]
        for si, s in enumerate(stats):
            v = F.col(f"_s{si}_{ci}")
            fields.append((v.cast(types[s]) if s in types else v).alias(s))
        rows.append(F.struct(*fields))
    return wide.select(F.inline(F.array(*rows)))


def one_row(df: DataFrame, exprs: dict[str, Column]) -> dict:
    """Run a single global aggregation and return it as a Python dict (one small row)."""
    row = df.agg(*[e.alias(k) for k, e in exprs.items()]).collect()[0]
    return row.asDict()
