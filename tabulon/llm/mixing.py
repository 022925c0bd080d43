"""Mixing sources to target weights by systematic sampling.

Every source gets a target number of words from its weight; a document's expected number of copies
is target / source size. Within a source the expected copies are prefix-summed in the order
(size, id), one random offset in [0, 1) is added, and a document is emitted once for every integer
boundary that its stretch of the running sum crosses. Because the order is by size, the words
taken differ from the target by about one largest document at most.

The running sum is exact: copies are counted in units of 1 / ``UNIT`` as integers, so the result
does not depend on partitioning, and reruns agree. No source is ever put into one task: rows are
range-partitioned by (source, size, id), each range is numbered on written storage, its total is
one small row, and only those totals are scanned in order.

Defined results: a null text has size 0. Null is a source of its own, ordered last. Sources of
size 0 have target 0. Documents repeated in the input are documents of their own; equal sizes and
ids are ordered by a hash of the text, so the result does not depend on where rows lie. A text is one
value of a task; its words are counted there, very long ones need a few times their size. An empty
table gives an empty result. Other columns, whatever their names, are only carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import row_key, text_or_empty, word_array, written

#: Fractions of a copy are counted in these units.
UNIT = 1_000_000_000
#: A document is taken this often at most.
MAX_COPIES = 3
#: The weights of sources in code point order, repeating.
WEIGHTS = (1, 2, 3)


def word_count(text: str | Column) -> Column:
    return F.size(word_array(text_or_empty(text))).cast("long")


def cycle_weights(sizes: DataFrame, weights=WEIGHTS) -> DataFrame:
    """(source, source_size) -> adds ``weight``: the given weights, repeating, over the sources in
    code point order, null last. One row per source: a list of sources, not of documents."""
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    choice = F.lit(float(weights[-1]))
    for i, w in enumerate(weights[:-1]):
        choice = F.when(nth % len(weights) == i, F.lit(float(w))).otherwise(choice)
    return sizes.withColumn("weight", choice)


def share_out(weighted: DataFrame, cap: float = MAX_COPIES) -> DataFrame:
    """(source, source_size, weight) -> adds ``target``: the total size shared by weight, where a
    target stops at ``cap`` times its source's size and the excess is shared again by weight until
    none is above.

    Closed form: take the sources in ascending order of cap / weight and let every prefix of them
    stop at its cap; the words left per unit of weight rise while the next source would exceed its
    cap and fall afterwards, so their maximum is the level at which nothing is above."""
    limit = F.col("source_size") * F.lit(float(cap))
    order = Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0.0))
    return (weighted.withColumn("per_weight", left / F.sum("weight").over(after))
            .withColumn("target", F.least(limit, F.max("per_weight").over(everything) * F.col("weight")))
            .select("source", "source_size", "weight", "target"))


def _offset(seed: int) -> Column:
    """One random offset per source in [0, UNIT): from the MD5 of seed and source, so that every
    engine and rerun draws the same."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null")))
    drawn = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")
    return F.shiftright(drawn * F.lit(UNIT), 32)


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", weights=WEIGHTS, cap: int = MAX_COPIES,
             seed: int = 9) -> DataFrame:
    """One row per document: id, source, size, source_size, target, copies, and its row key."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       word_count(text_col).alias("size"), *_row_key(F.col(id_col), text_or_empty(text_col), F.col(source_col)))
    ordered = (slim.repartitionByRange(F.col("source").asc_nulls_last(), "size", F.col("id").asc_nulls_last(), "key_a", "key_b")
               .withColumn("range", F.spark_partition_id()))
    ordered = written(ordered, "mixing_ranges")
    totals = ordered.groupBy("source", "range").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    totals = written(totals, "mixing_totals")  # one row per source and range
    sizes = totals.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = share_out(cycle_weights(sizes, weights), cap)
    expected = F.when(F.col("source_size") > 0,
                      F.floor(F.col("target") / F.col("source_size") * F.lit(float(UNIT)))).otherwise(F.lit(0))
    targets = targets.withColumn("expected", expected.cast("decimal(20,0)"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("n")).over(before), F.lit(0)).cast("decimal(18,0)")
    ranges = (totals.withColumn("rows_before", start)
              .join(targets.withColumnRenamed("source", "target_source"),
                    F.col("source").eqNullSafe(F.col("target_source")))
              .select(F.col("source").alias("range_source"), F.col("range").alias("range_no"), "rows_before",
                      "source_size", "target", "expected", _offset(seed).cast("decimal(18,0)").alias("offset")))
    ranges = written(ranges, "mixing_plan")
    inside = Window.partitionBy("range", "source").orderBy("size", F.col("id").asc_nulls_last(), "key_a", "key_b")
    nth = F.row_number().over(inside).cast("decimal(18,0)")
    numbered = ordered.withColumn("nth", nth)
    joined = numbered.join(ranges, (F.col("range") == F.col("range_no"))
                           & F.col("source").eqNullSafe(F.col("range_source")))
    # boundaries crossed = integer part after the document minus integer part before it
    upto = f"cast((rows_before + nth) * expected + offset as decimal(38,0)) div {UNIT}"
    below = f"cast((rows_before + nth - 1) * expected + offset as decimal(38,0)) div {UNIT}"
    return joined.select("id", "source", "size", "source_size", "target",
                         (F.expr(upto) - F.expr(below)).cast("long").alias("copies"), "key_a", "key_b")


def _row_key(id_col: Column, text: Column, source: Column) -> list[Column]:
    """128 bits that stand for id, text and source; rows that repeat all three share them."""
    unset = source.isNull()
    return [F.xxhash64(id_col, text, source, unset).alias("key_a"),
            F.xxhash64(source, text, id_col, unset, F.lit(1)).alias("key_b")]


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, cap: int = MAX_COPIES, seed: int = 9) -> DataFrame:
    """The mixture: every document as often as it was taken, with all its columns.

    Documents meet their number of copies in one shuffle. Rows that repeat id, text and source share
    theirs: of the n of them, in the order of a hash of the whole row, the first ones are taken once
    more than the others, so that the sum is theirs."""
    key = ["key_a", "key_b"]
    plan = (plan_mix(docs, id_col, text_col, source_col, weights, cap, seed).groupBy(*key)
            .agg(F.sum("copies").alias("copies"), F.count("*").alias("repeats")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), F.struct(*row_key(docs)).alias("row"),
                       *_row_key(F.col(id_col), text_or_empty(text_col), F.col(source_col)))
    nth = F.row_number().over(Window.partitionBy(*key).orderBy("row"))
    more = F.when(F.col("nth") <= F.expr("copies % repeats"), 1).otherwise(0)
    taken = rows.withColumn("nth", nth).join(plan, key).withColumn("taken", F.expr("copies div repeats") + more)
    return (taken.filter("taken > 0")
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("taken").cast("int"))))
            .select("whole.*"))
