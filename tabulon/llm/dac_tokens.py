"""Token ids in directly addressable codes.

Documents are range-partitioned and sorted by id; every task encodes its documents and appends an
end id to each. Ids are packed into segments of whole documents, about ``SEGMENT_TOKENS`` ids each.
In a segment an id is split into chunks of ``WIDTH`` bits, low chunk first. Level 0 holds the low
chunk of every id, a bitmap with one bit per id says whether the id continues, and level 1 holds
the next chunk of the ids that continue, in order, and so on. A rank directory over each bitmap
counts the set bits before every ``RANK_BITS`` bits, so the chunk of id i on the next level is found
at rank(i): any id is read with one look per level, and no block is decoded.

File format: a folder of uncompressed Parquet files, one row per segment: part, segment, n_tokens,
ids (document ids), lengths (ids per document, end id included), levels (array of chunks, bitmap,
ranks). Parts are in document order, segments in order within a part. Written by Spark to any
file system that it writes to.

Defined results: null and empty texts have the end id only. Null document ids come last. Rows that
repeat an id follow one another in the order of their texts. An empty table makes files without
segments. Only the id and the text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .byte_bpe import ByteBPE
from .common import process_cache

WIDTH = 8
RANK_BITS = 512
SEGMENT_TOKENS = 1 << 20
BATCH_CHARS = 3_000_000

_LEVEL = T.StructType([T.StructField(n, T.BinaryType()) for n in ("chunks", "bitmap", "ranks")])


def pack(ids: np.ndarray) -> list[dict]:
    """The levels of an array of unsigned ids."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest >> np.uint32(WIDTH)
        goes_on = more > 0
        per_block = np.add.reduceat(goes_on, np.arange(0, len(rest), RANK_BITS)) if len(rest) else np.zeros(0)
        ranks = np.concatenate([[0], np.cumsum(per_block)[:-1]]) if len(rest) else np.zeros(0)
        levels.append({"chunks": (rest & np.uint32((1 << WIDTH) - 1)).astype(np.uint8).tobytes(),
                       "bitmap": np.packbits(goes_on).tobytes(), "ranks": ranks.astype(np.uint32).tobytes()})
        if not goes_on.any():
            return levels
        rest = more[goes_on]


def unpack(levels: list[dict]) -> np.ndarray:
    """All ids of a segment."""
    out, where = None, None
    for k, level in enumerate(levels):
        chunks = np.frombuffer(level["chunks"], dtype=np.uint8).astype(np.uint32)
        if k == 0:
            out, where = chunks, np.arange(len(chunks))
        else:
            out[where] |= chunks << np.uint32(WIDTH * k)
        bits = np.unpackbits(np.frombuffer(level["bitmap"], dtype=np.uint8), count=len(chunks))
        where = where[bits.astype(bool)]
    return out


def access(levels: list[dict], at: np.ndarray) -> np.ndarray:
    """The ids at some positions: one look per level, by rank."""
    out = np.zeros(len(at), dtype=np.uint32)
    pos, live = at.astype(np.int64), np.arange(len(at))
    for k, level in enumerate(levels):
        chunks, bitmap = (np.frombuffer(level[n], dtype=np.uint8) for n in ("chunks", "bitmap"))
        ranks = np.frombuffer(level["ranks"], dtype=np.uint32)
        out[live] |= chunks[pos].astype(np.uint32) << np.uint32(WIDTH * k)
        goes_on = (bitmap[pos >> 3] >> (7 - (pos & 7)).astype(np.uint8)) & 1 == 1
        pos, live = pos[goes_on], live[goes_on]
        if not len(pos):
            break
        rank = np.empty(len(pos), dtype=np.int64)
        for i, p in enumerate(pos):  # set bits between the directory's entry and the position
            block = int(p) // RANK_BITS * RANK_BITS
            part = np.unpackbits(bitmap[block >> 3: (int(p) >> 3) + 1])[: int(p) - block]
            rank[i] = int(ranks[int(p) // RANK_BITS]) + int(part.sum())
        pos = rank
    return out


def _bpe(definition) -> ByteBPE:
    cache = process_cache()
    key = ("byte_bpe", definition.id if hasattr(definition, "id") else id(definition))
    if key not in cache:
        cache[key] = ByteBPE(definition.value)
    return cache[key]


def _segments(definition, end_id: int, id_type: pa.DataType, segment_tokens: int, batch_chars: int):
    level = pa.struct([("chunks", pa.binary()), ("bitmap", pa.binary()), ("ranks", pa.binary())])
    schema = pa.schema([("segment", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(id_type)),
                        ("lengths", pa.list_(pa.int64())), ("levels", pa.list_(level))])

    def encoded(batches, bpe) -> Iterator[tuple[list, list[np.ndarray]]]:
        for batch in batches:
            names, texts, size = [], [], 0
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                names.append(name)
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= batch_chars:
                    yield names, bpe.encode(texts)
                    names, texts, size = [], [], 0
            if names:
                yield names, bpe.encode(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, number = _bpe(definition), 0
        names, lengths, held, size = [], [], [], 0

        def flush():
            row = {"segment": number, "n_tokens": size, "ids": names, "lengths": lengths,
                   "levels": pack(np.concatenate(held))}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for some, ids in encoded(batches, bpe):
            for name, own in zip(some, ids, strict=True):
                names.append(name)
                lengths.append(len(own) + 1)
                held.extend((own, np.array([end_id], dtype=np.uint32)))
                size += len(own) + 1
                if size >= segment_tokens:
                    yield flush()
                    number, names, lengths, held, size = number + 1, [], [], [], 0
        if names:
            yield flush()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", segment_tokens: int = SEGMENT_TOKENS,
                 batch_chars: int = BATCH_CHARS) -> None:
    """Encode all documents into the file format above at ``path``. The tokenizer's definition is
    read by the driver and broadcast; its size is the vocabulary's."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = slim.schema["id"].dataType
    ordered = (slim.repartitionByRange(F.col("id").asc_nulls_last())
               .sortWithinPartitions(F.col("id").asc_nulls_last(), "text"))
    schema = T.StructType([T.StructField("segment", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.ArrayType(id_type)), T.StructField("lengths", T.ArrayType(T.LongType())),
                           T.StructField("levels", T.ArrayType(_LEVEL))])
    from pyspark.sql.pandas.types import to_arrow_type

    segments = ordered.mapInArrow(
        _segments(definition, end_id, to_arrow_type(id_type), segment_tokens, batch_chars), schema)
    (segments.withColumn("part", F.spark_partition_id()).write.option("compression", "none").parquet(path))


def segment_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, segment, first, n_tokens): ids before each segment. Sums per part are one row a part;
    the segments of a part are summed within it. Reads no levels."""
    index = spark.read.parquet(path).select("part", "segment", "n_tokens")
    parts = index.groupBy("part").agg(F.sum("n_tokens").alias("in_part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("part_first"))
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    return (index.withColumn("in_before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .join(parts, "part")
            .select("part", "segment", (F.col("part_first") + F.col("in_before")).alias("first"), "n_tokens"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: id, start (ids of all documents before it), n_tokens (end id
    included), ids_crc32 (of its ids as little-endian unsigned 32-bit integers)."""
    files = spark.read.parquet(path)
    id_field = T.StructField("id", files.schema["ids"].dataType.elementType)
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("segment", T.LongType()), id_field,
                           *[T.StructField(n, T.LongType()) for n in ("offset", "n_tokens", "ids_crc32")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(n)[k] for n in batch.schema.names}
                ids = unpack(row["levels"].as_py()).astype("<u4")
                lengths = row["lengths"].values.to_numpy()
                ends = np.cumsum(lengths)
                sums = [zlib.crc32(memoryview(ids[b - n:b])) for b, n in zip(ends, lengths, strict=True)]
                n = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"].as_py()] * n, pa.int32()), pa.array([row["segment"].as_py()] * n, pa.int64()),
                     row["ids"].values, pa.array(ends - lengths), pa.array(lengths), pa.array(sums, pa.int64())],
                    names=schema.names)

    # few segments per Arrow batch: a segment is megabytes
    decoded = files.select("part", "segment", "ids", "lengths", "levels").mapInArrow(run, schema)
    return decoded.join(segment_starts(spark, path).drop("n_tokens"), ["part", "segment"]).select(
        "id", (F.col("first") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def read_tokens(positions: DataFrame, path: str, position_col: str = "position") -> DataFrame:
    """(position, token) of any positions in the whole sequence of ids, by random access. Positions
    find their segment by equality on the stretch of ``SEGMENT_TOKENS`` they lie in; only segments
    that are asked for are read into a task, one at a time."""
    spark = positions.sparkSession
    wide = F.lit(SEGMENT_TOKENS)
    starts = segment_starts(spark, path).withColumn("stretch", F.explode(F.sequence(
        F.floor(F.col("first") / wide), F.floor((F.col("first") + F.col("n_tokens") - 1) / wide))))
    asked = positions.select(F.col(position_col).cast("long").alias("position")).withColumn(
        "stretch", F.floor(F.col("position") / wide))
    found = (asked.join(starts, "stretch")
             .filter("position >= first and position < first + n_tokens")
             .groupBy("part", "segment").agg(F.first("first").alias("first"), F.collect_list("position").alias("at")))
    files = spark.read.parquet(path).select("part", "segment", "levels")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at = np.array(row["at"], dtype=np.int64)
                ids = access(row["levels"], at - row["first"])
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(ids.astype(np.int64))], names=["position", "token"])

    return files.join(found, ["part", "segment"]).select("first", "at", "levels").mapInArrow(
        run, "position long, token long")
