"""Exact deduplication with a heavy-hitter split.

1. A slim table (id, row address, SHA-256 of the normalised text) is written once.
2. Every task keeps a Misra-Gries summary of ``counters`` digests; summaries are added by digest.
   With N rows, each digest of more than 2N / (counters + 1) rows has a summed estimate above
   N / (counters + 1), and at most ``counters`` digests can have one: the candidates are bounded
   whatever the data.
3. The candidates' exact sizes and winners are counted with map-side combining (one row a task
   and digest is shuffled) and broadcast: at most ``counters`` rows.
4. Copies of a heavy digest are resolved map-side and never shuffled. What remains has no group
   larger than 2N / (counters + 1) rows and goes through an ordinary shuffle by digest.

Defined results: a null text equals the empty text. Of equal texts the row with the smallest id
stays, null ids last. Rows that repeat both id and text are copies of one another: exactly one
stays, the one with the smallest hash of the whole row (``drop_copies``), so the result does not
depend on where rows lie. A text is one value of a task; very long ones need a few times their size. An empty table gives an empty result. Other columns of the input are never looked at, so
their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import collapse_space, row_key, text_or_empty, written

#: Counters of a Misra-Gries summary, and so the bound on broadcast rows.
COUNTERS = 1024


def text_digest(text: str | Column) -> Column:
    """SHA-256 (binary) of the text with white space runs collapsed, in UTF-8."""
    return F.unhex(F.sha2(collapse_space(text_or_empty(text)).cast("binary"), 256))


def _misra_gries(counters: int):
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            for pair in batch.column(0).value_counts().to_pylist():
                counts[pair["values"]] = counts.get(pair["values"], 0) + pair["counts"]
            if len(counts) > counters:  # Misra-Gries merge: subtract the (counters + 1)-th count
                cut = sorted(counts.values(), reverse=True)[counters]
                counts = {k: v - cut for k, v in counts.items() if v > cut}
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
            names=["digest", "estimate"])

    return summarise


def heavy_digests(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(digest, estimate): at most ``counters`` digests, every one of more than
    2N / (counters + 1) rows among them."""
    n = digests.count()
    return (digests.select("digest").mapInArrow(_misra_gries(counters), "digest binary, estimate long")
            .groupBy("digest").agg(F.sum("estimate").alias("estimate"))
            .filter(F.col("estimate") * (counters + 1) > n))


def _address() -> Column:
    """Orders the rows of a digest: ids ascending, null ids last, then the row's address."""
    return F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("row"))


def _heavy_groups(slim: DataFrame, counters: int) -> DataFrame:
    """(digest, winner, group_size) of the heavy digests that have copies, exactly counted."""
    candidates = heavy_digests(slim, counters).select("digest")
    exact = (slim.join(F.broadcast(candidates), "digest")
             .groupBy("digest").agg(F.min(_address()).alias("winner"), F.count("*").alias("group_size"))
             .filter("group_size > 1"))
    return written(exact, "exact_dedup_heavy")


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                counters: int = COUNTERS) -> DataFrame:
    """One row per input row: id, keep_id (id of the row that stays), group_size, kept, digest."""
    slim = written(docs.select(F.col(id_col).alias("id"), text_digest(text_col).alias("digest"))
                   .withColumn("row", F.monotonically_increasing_id()), "exact_dedup_digests")
    heavy = _heavy_groups(slim, counters)
    resolved = slim.join(F.broadcast(heavy), "digest")
    group = Window.partitionBy("digest")
    rest = (slim.join(F.broadcast(heavy), "digest", "left_anti")
            .withColumn("winner", F.min(_address()).over(group))
            .withColumn("group_size", F.count("*").over(group)))
    return resolved.unionByName(rest).select(
        "id", F.col("winner.id").alias("keep_id"), "group_size",
        (F.col("winner.row") == F.col("row")).alias("kept"), "digest")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                counters: int = COUNTERS) -> DataFrame:
    """The rows that stay, with all their columns.

    Copies of a heavy digest are dropped where they lie. What remains is shuffled once by digest, text
    and all; Spark limits a digest to its first row in every task before that, so rows that are equal
    in all their columns, however many, are one row a task."""
    slim = written(docs.select(F.col(id_col).alias("id"), text_digest(text_col).alias("digest"), F.struct(*row_key(docs)).alias("row")),
                   "exact_dedup_digests")
    heavy = F.broadcast(_heavy_groups(slim, counters).select("digest", "winner"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), F.struct(*row_key(docs)).alias("row"),
                       F.col(id_col).alias("id"), text_digest(text_col).alias("digest"))
    survivors = rows.join(heavy, "digest", "left").filter(
        F.col("winner").isNull() | (F.col("id").eqNullSafe(F.col("winner.id")) & (F.col("row") == F.col("winner.row"))))
    first = Window.partitionBy("digest").orderBy(F.col("id").asc_nulls_last(), "row")
    return (survivors.withColumn("nth", F.row_number().over(first)).filter("nth = 1")
            .select("whole.*"))
