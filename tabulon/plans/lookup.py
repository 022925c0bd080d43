"""Joining rows with a small statistics table (class counts, group fills, code dictionaries).

The table is an aggregate of the rows, so its size is unknown when the join is planned and the
adaptive planner would shuffle the rows on the key before it finds out. It is therefore written
first to shared storage; its true row count then decides, at planning time, between a broadcast
(the rows stay where they are, also under a hot key) and an ordinary shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.session import scratch_path

#: A statistics table up to this many rows is broadcast.
BROADCAST_ROWS = 200_000


def materialised(stats: DataFrame) -> DataFrame:
    """The table, computed once and read back."""
    path = scratch_path(stats.sparkSession, "lookup")
    stats.write.parquet(path)
    return stats.sparkSession.read.schema(stats.schema).parquet(path)


def sized(stats: DataFrame, rows: int | None = None) -> DataFrame:
    """A written table with a broadcast hint if its row count (counted here if not given) allows it."""
    return F.broadcast(stats) if (stats.count() if rows is None else rows) <= BROADCAST_ROWS else stats


def attach(df: DataFrame, stats: DataFrame, keys: list[str], how: str = "inner",
           null_safe: bool = True, rows: int | None = None) -> DataFrame:
    """``df`` joined with a written ``stats`` table on equally named ``keys`` (NULL keys match with
    ``null_safe``); the rows' own key columns are kept. ``rows`` is the table's row count, if known."""
    renamed = stats.select(*[F.col(k).alias(f"_at_{k}") for k in keys],
                           *[c for c in stats.columns if c not in keys])
    cond = [F.col(k).eqNullSafe(F.col(f"_at_{k}")) if null_safe else F.col(k) == F.col(f"_at_{k}")
            for k in keys]
    return df.join(sized(renamed, rows), on=cond, how=how).drop(*[f"_at_{k}" for k in keys])
