"""Sharding by sampled splitters: shards of near-equal bytes, whose records lie in key order.

1. A slim table of (key, size) is written once. The key is (hash of the text, id), so equal texts
   are neighbours and meet in one shard unless a shard boundary has to cut their run.
2. A size-weighted sample of keys is drawn: a record of size s stands in it s * rate times in
   expectation, decided by a hash of the key. Every ``PER_RANGE``-th sampled key is a splitter.
3. Records are range-partitioned by the splitters (binary search in an array of them) and every
   range's exact bytes and rows are counted. Ranges above ``OVERFULL`` times the aimed size are
   sampled again, more densely, and subdivided, until none is overfull or only one key is left.
4. Ranges, many per shard, are dealt to shards in key order by their exact running sum of bytes.
5. Records move once, to their range, and are numbered there; a record's slot is its range's
   offset in the shard plus that number.

Only splitters and range totals pass the driver: ``RANGES_PER_SHARD`` ranges a shard, or one for
``RANGE_ROWS`` records where that is more. Everything is DataFrame functions.

Defined results: a null text is empty (size 8). Null ids sort first. Records that repeat both text
and id are not told apart by the key, so they share a range. An empty table gives an empty result.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from .common import text_or_empty, written

RANGES_PER_SHARD = 64
RANGE_ROWS = 1_000_000
#: Sampled keys per range.
PER_RANGE = 16
OVERFULL = 2.0
#: Bytes that a record takes beside its text.
RECORD_BYTES = 8

_KEY = "struct<h:bigint,id:bigint>"


def record_size(text: str | Column) -> Column:
    return (F.octet_length(text_or_empty(text)) + RECORD_BYTES).cast("long")


def _key(text: str, id_col: str) -> Column:
    return F.struct(F.xxhash64(text_or_empty(text)).alias("h"), F.col(id_col).cast("long").alias("id"))


def _sampled(slim: DataFrame, rate: Column, seed: int) -> list:
    """Keys drawn in proportion to size, in order: floor(size * rate + u) times each, u a uniform
    hash of the key."""
    u = F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = (slim.withColumn("times", F.floor(F.col("size") * rate + u)).filter("times > 0")
             .groupBy("key").agg(F.sum("times").alias("times")))
    return sorted(((_plain(r["key"]), r["times"]) for r in drawn.collect()))


def _plain(key: Row) -> tuple:
    """Sort order of Spark's structs: nulls first."""
    return (key["h"], key["id"] is not None, key["id"] if key["id"] is not None else 0)


def _quantiles(sample: list, step: float) -> list[tuple]:
    """Every key at which the sample's running weight passes a multiple of ``step``."""
    out, passed, total = [], 0, 0
    for key, times in sample:
        total += times
        if total // step > passed:
            passed = total // step
            out.append(key)
    return out


def _range_of(splitters: list[tuple]) -> Column:
    """Number of splitters below the key: binary search, one comparison for each halving."""
    if not splitters:
        return F.lit(0)
    # a foldable expression: parsed once into a literal array
    array = F.from_json(F.lit(json.dumps([{"h": h, "id": i if known else None} for h, known, i in splitters])),
                        f"array<{_KEY}>")
    n, steps = len(splitters), []
    step = 1 << (n.bit_length() - 1)
    while step:
        steps.append(step)
        step >>= 1

    def advance(pos: Column, step: Column) -> Column:
        return F.when((pos + step <= n) & (F.get(array, pos + step - 1) < F.col("key")), pos + step).otherwise(pos)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), advance)


def choose_splitters(slim: DataFrame, shards: int, seed: int = 10, rounds: int = 8) -> tuple[list[tuple], list]:
    """Splitters, and (range, bytes, rows) of every range that has records, in order."""
    total = slim.agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).first()
    if not total["rows"]:
        return [], []
    wanted = max(shards * RANGES_PER_SHARD, -(-total["rows"] // RANGE_ROWS))
    aim = total["bytes"] / wanted
    sample = _sampled(slim, F.lit(PER_RANGE / aim), seed)
    splitters = _quantiles(sample, PER_RANGE)
    for again in range(rounds):
        placed = slim.withColumn("range", _range_of(splitters))
        totals = sorted((r["range"], r["bytes"], r["rows"], r["keys"] > 0) for r in placed.groupBy("range").agg(
            F.sum("size").alias("bytes"), F.count("*").alias("rows"),
            (F.max("key") != F.min("key")).cast("int").alias("keys")).collect())
        full = [r for r, size, _, divisible in totals if divisible and size > OVERFULL * aim]
        if not full or again == rounds - 1:
            break
        inside = placed.filter(F.col("range").isin(full)).select("key", "size")
        denser = _quantiles(_sampled(inside, F.lit(PER_RANGE * 4 / aim), seed + 1 + again), PER_RANGE * 2)
        merged = sorted(set(splitters) | set(denser))
        if merged == splitters:
            break
        splitters = merged
    return splitters, totals


def shard_records(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
                  seed: int = 10) -> DataFrame:
    """Every input row (struct ``record``) with its size, shard and slot; rows lie in the
    partitions of their ranges, in key order within one, ready to be written by shard."""
    slim = written(docs.select(_key(text_col, id_col).alias("key"), record_size(text_col).alias("size")),
                   "sharding_keys")
    splitters, totals = choose_splitters(slim, shards, seed)
    plan, total, run, slot, last = [], sum(t[1] for t in totals), 0, 0, 0
    for number, size, rows, _ in totals:
        shard = min(shards - 1, int((2 * run + size) * shards // (2 * total)))
        slot = slot if shard == last else 0
        plan.append((number, shard, slot))
        run, slot, last = run + size, slot + rows, shard
    spark = docs.sparkSession
    ranges = spark.createDataFrame(plan, "range int, shard int, first_slot long")
    records = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"),
                          _key(text_col, id_col).alias("key"), record_size(text_col).alias("size")
                          ).withColumn("range", _range_of(splitters))
    inside = Window.partitionBy("range").orderBy("key")
    numbered = records.withColumn("nth", F.row_number().over(inside) - 1)
    # one row a range: bounded by the number of ranges, checked by its construction above
    return numbered.join(F.broadcast(ranges), "range").select(
        "record", "size", "shard", (F.col("first_slot") + F.col("nth")).alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Shard files: the records, one folder per shard, slots ascending within a file."""
    (sharded.select("record.*", F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
     .write.partitionBy("_shard").parquet(path))
