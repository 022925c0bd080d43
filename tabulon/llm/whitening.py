"""Whitening of embeddings with MLlib's distributed block matrices.

1. *Blocks.* Every task turns its remaining vectors into whole numbers and writes them in blocks of
   ``ROWS_PER_BLOCK`` rows with their ids and column sums (one pass over the input). Blocks are
   numbered by task and place, so they are the same however often they are read.
2. *Scatter.* The sums of the blocks give n and S. Centred rows ``(n*x - S) / n`` (exact up to the
   division) are the blocks of a tall ``BlockMatrix``, the last block of a task filled up with zero
   rows; transpose times matrix is the scatter. The middle dimension is cut in splits of
   ``BLOCKS_PER_SPLIT`` blocks, so no task holds more, and the partial products are summed by key.
3. *Components.* The scatter (dimensions squared) is local: its eigenvectors by falling eigenvalue.
4. *Projection.* Spark deals the blocks of a product out on a square grid, so the same blocks are
   laid out as a square of panels, side by side, and multiplied with a block diagonal matrix of the
   whitening matrix: every block meets its copy of it and the tasks are as many as the partitions.
5. *Check.* The transpose product of the projected blocks gives the covariance of the whitened rows,
   whose largest difference from the identity is ``identity_error``.

Numbers per dimension and per component pass the driver, and inside MLlib the numbers of the blocks
(one pair for a thousand rows). Every intermediate table is written to the shared folder.

Defined results: rows with a null vector, or one with null or non-finite entries, are dropped; so
are entries whose whole number does not lie within ``LIMIT``, as if they were not finite, and
vectors of another length than the most frequent one (of equally frequent ones the longest), which
have no place in the space. Repeated rows, ids and null ids are rows like others. Components without
variance (eigenvalue below 1e-12 of the trace) have a null ``whitened`` and do not count in
``identity_error``; there are at most as many components as dimensions. A deviation beyond a long is
null. An empty table, or one without a remaining row, gives an empty result. Only the id and the
vector are read, so further columns of any name do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import written

ROWS_PER_BLOCK = 1024
#: Row blocks whose products one task adds up.
BLOCKS_PER_SPLIT = 64
#: Whole numbers of entries lie within this.
LIMIT = 1 << 40
#: A component with a smaller share of the trace has no variance.
NO_VARIANCE = 1e-12


def whole_numbers(vectors: pa.Array, scale: int, shift: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimensions, rows, floor(scale * entry) + shift) of the remaining vectors, by length."""
    known = np.flatnonzero(vectors.is_valid().to_numpy(zero_copy_only=False))
    lists = vectors.take(pa.array(known))
    flat = lists.flatten().cast(pa.float64())
    values = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False)
    lengths = np.asarray(lists.value_lengths().fill_null(0), dtype=np.int64)
    starts = np.cumsum(lengths) - lengths
    for dim in np.unique(lengths[lengths > 0]):
        some = np.flatnonzero(lengths == dim)
        scaled = np.floor(values[starts[some][:, None] + np.arange(dim)] * scale)
        good = (np.abs(scaled) < LIMIT).all(axis=1)  # false for NaN and infinities
        if good.any():
            yield int(dim), known[some[good]], scaled[good].astype(np.int64) + shift


def _blocks(scale: int, shift: int, rows_per_block: int, id_type: pa.DataType):
    schema = pa.schema([("part", pa.int32()), ("place", pa.int64()), ("dim", pa.int32()), ("ids", pa.list_(id_type)),
                        ("sums", pa.list_(pa.int64())), ("x", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        held: dict[int, tuple[list, list]] = {}

        def blocks(dim: int, least: int):
            nonlocal place
            ids, x = pa.concat_arrays(held[dim][0]), np.concatenate(held[dim][1])
            at = 0
            while len(x) - at >= least:
                some = x[at:at + rows_per_block]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([place]), pa.array([dim], pa.int32()),
                     pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), ids.slice(at, len(some))),
                     pa.array([some.sum(axis=0).tolist()], pa.list_(pa.int64())), pa.array([some.tobytes()], pa.binary())],
                    schema=schema)
                place, at = place + 1, at + len(some)
            held[dim] = ([ids.slice(at)], [x[at:]])

        for batch in batches:
            for dim, rows, x in whole_numbers(batch.column(1), scale, shift):
                ids, parts = held.setdefault(dim, ([], []))
                ids.append(batch.column(0).take(pa.array(rows)))
                parts.append(x)
                if sum(map(len, parts)) >= rows_per_block:
                    yield from blocks(dim, rows_per_block)
        for dim in held:
            yield from blocks(dim, 1)

    return run


def write_blocks(vectors: DataFrame, id_col: str, vector_col: str, scale: int, shift: int,
                 rows_per_block: int) -> DataFrame:
    """The written table of row blocks (block, ids, sums, x) of the vectors of the usual length;
    ``block`` counts from 0 without gaps."""
    slim = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("vector"))
    id_type = slim.schema["id"].dataType
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("place", T.LongType()),
                           T.StructField("dim", T.IntegerType()), T.StructField("ids", T.ArrayType(id_type)),
                           T.StructField("sums", T.ArrayType(T.LongType())), T.StructField("x", T.BinaryType())])
    made = written(slim.mapInArrow(_blocks(scale, shift, rows_per_block, to_arrow_type(id_type)), schema), "white_blocks")
    usual = (made.groupBy("dim").agg(F.sum(F.size("ids")).alias("n")).orderBy(F.desc("n"), F.desc("dim")).limit(1)).collect()
    made = made.filter(F.col("dim") == (usual[0]["dim"] if usual else 0))
    parts = made.groupBy("part").agg(F.count("*").alias("blocks"))  # one row for each task
    before = F.coalesce(F.sum("blocks").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before.alias("first"))
    nth = F.row_number().over(Window.partitionBy("part").orderBy("place")) - 1
    places = made.select("part", "place", nth.alias("nth")).join(parts, "part").select(
        "part", "place", (F.col("first") + F.col("nth")).alias("block"))
    return written(made.join(places, ["part", "place"]).select("block", "ids", "sums", "x"), "white_numbered")


def _matrix(blocks: DataFrame, to_matrix, coordinates, rows: int, cols: int, shape: tuple[int, int]) -> BlockMatrix:
    """A block matrix of (block, x): ``to_matrix`` gives a block's values, ``coordinates`` its place."""
    def block(row):
        m = to_matrix(row["x"])
        full = np.zeros((rows, cols))
        full[:len(m)] = m
        return coordinates(row["block"]), DenseMatrix(rows, cols, full.ravel(order="F"))

    return BlockMatrix(blocks.select("block", "x").rdd.map(block), rows, cols, shape[0] * rows, shape[1] * cols)


def _scatter(tall: BlockMatrix, n_blocks: int) -> np.ndarray:
    """Transpose times matrix. The call with a number of splits of the middle dimension is not in
    the Python class, so it is made on the wrapped matrix."""
    turned = tall.transpose()
    product = turned._java_matrix_wrapper.call("multiply", tall._java_matrix_wrapper._java_model,
                                               max(1, -(-n_blocks // BLOCKS_PER_SPLIT)))
    return BlockMatrix(product, tall.colsPerBlock, tall.colsPerBlock).toLocalMatrix().toArray()


@dataclass
class Whitening:
    n: int
    sums: list[int]
    eigenvalues: np.ndarray  # falling
    components: np.ndarray  # one column for each component
    trace: float

    def matrix(self, k: int) -> np.ndarray:
        """Dimensions x k: components over the root of their eigenvalue, zero without variance."""
        e = self.eigenvalues[:k]
        some = e > NO_VARIANCE * self.trace
        return np.where(some, self.components[:, :k] / np.sqrt(np.where(some, e, 1.0)), 0.0)


def _centred(n: int, sums: list[int]):
    s = np.array(sums, dtype=object)
    small = all(abs(v) < 1 << 62 for v in sums)

    def to_matrix(x: bytes) -> np.ndarray:
        x = np.frombuffer(x, dtype=np.int64).reshape(-1, len(sums))
        if small and int(np.abs(x).max()) * n < 1 << 61:
            return (x * n - s.astype(np.int64)) / n
        return ((x.astype(object) * n - s) / n).astype(np.float64)

    return to_matrix


def fit(blocks: DataFrame, rows_per_block: int = ROWS_PER_BLOCK) -> tuple[Whitening, int] | None:
    """(whitening, number of blocks) of a written block table; None without rows."""
    per_dim = blocks.select(F.posexplode("sums").alias("dim", "v")).groupBy("dim").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).orderBy("dim").collect()
    count = blocks.agg(F.count("*").alias("blocks"), F.sum(F.size("ids")).alias("n")).first()
    if not per_dim:
        return None
    n, sums, dim = int(count["n"]), [int(r["s"]) for r in per_dim], len(per_dim)
    tall = _matrix(blocks, _centred(n, sums), lambda b: (b, 0), rows_per_block, dim, (count["blocks"], 1))
    values, vectors = np.linalg.eigh(_scatter(tall, count["blocks"]) / n)
    values = np.maximum(values[::-1], 0.0)
    return Whitening(n, sums, values, vectors[:, ::-1], float(values.sum())), count["blocks"]


def _projected(blocks: DataFrame, found: Whitening, n_blocks: int, k: int, rows_per_block: int) -> DataFrame:
    """The written table (block, z): rows of k whitened values, filled up with zero rows."""
    spark, dim = blocks.sparkSession, len(found.sums)
    panels = math.isqrt(n_blocks - 1) + 1
    square = _matrix(blocks, _centred(found.n, found.sums), lambda b: (b // panels, b % panels),
                     rows_per_block, dim, (-(-n_blocks // panels), panels))
    white = found.matrix(k)
    copies = spark.sparkContext.range(panels).map(lambda j: ((j, j), DenseMatrix(dim, k, white.ravel(order="F"))))
    product = square.multiply(BlockMatrix(copies, dim, k, panels * dim, panels * k))
    rows = product.blocks.map(lambda b: (b[0][0] * panels + b[0][1], bytearray(np.ascontiguousarray(b[1].toArray()).tobytes())))
    return written(spark.createDataFrame(rows, "block long, x binary"), "white_projected")


def _rows(found: Whitening, k: int, schema: pa.Schema):
    n, sums, dim = found.n, np.array(found.sums, dtype=object), len(found.sums)
    narrow = [bool(v > NO_VARIANCE * found.trace) for v in found.eigenvalues[:k]]

    def deviations(x: np.ndarray) -> list:
        reach = max(int(np.abs(x).max()) * n, max(map(abs, found.sums)))
        if dim * (2 * reach) ** 2 < 1 << 62:
            d = x * n - sums.astype(np.int64)
            return (d * d).sum(axis=1).tolist()
        d = x.astype(object) * n - sums
        return [v if v < 1 << 63 else None for v in (d * d).sum(axis=1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x, z in zip(*batch.columns, strict=True):
                ids = ids.values
                x = np.frombuffer(x.as_py(), dtype=np.int64).reshape(-1, dim)
                z = np.frombuffer(z.as_py(), dtype=np.float64).reshape(-1, k)[:len(x)]
                missing = np.broadcast_to(~np.array(narrow), z.shape).ravel()
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(np.repeat(np.arange(len(ids)), k))),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array([d for d in deviations(x) for _ in range(k)], pa.int64()),
                     pa.array(z.ravel(), mask=missing)], schema=schema)

    return run


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8,
           scale: int = 1024, shift: int = 100_000, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """One row per remaining row and component: id, component, n, deviation, whitened, explained,
    identity_error. Entries are floor(scale * entry) + shift."""
    spark = vectors.sparkSession
    id_type = vectors.schema[id_col].dataType
    blocks = write_blocks(vectors, id_col, vector_col, scale, shift, rows_per_block)
    schema = T.StructType([T.StructField("id", id_type), T.StructField("component", T.IntegerType()),
                           T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType())])
    fitted = fit(blocks, rows_per_block)
    if fitted is None:
        found, n, explained, error = spark.createDataFrame([], schema), 0, [0.0], 0.0
    else:
        model, n_blocks = fitted
        n, k = model.n, min(components, len(model.sums))
        projected = _projected(blocks, model, n_blocks, k, rows_per_block)
        tall = _matrix(projected, lambda z: np.frombuffer(z, dtype=np.float64).reshape(-1, k), lambda b: (b, 0),
                       rows_per_block, k, (n_blocks, 1))
        some = model.eigenvalues[:k] > NO_VARIANCE * model.trace
        apart = np.abs(_scatter(tall, n_blocks) / n - np.eye(k))[np.ix_(some, some)]
        error = float(apart.max()) if apart.size else 0.0
        explained = [float(v / model.trace) if model.trace else 0.0 for v in model.eigenvalues[:k]]
        pairs = blocks.select("block", "ids", "x").join(projected.select("block", F.col("x").alias("z")), "block")
        arrow = pa.schema([("id", to_arrow_type(id_type)), ("component", pa.int32()), ("deviation", pa.int64()),
                           ("whitened", pa.float64())])
        found = pairs.select("ids", "x", "z").mapInArrow(_rows(model, k, arrow), schema)
    share = F.element_at(F.array(*[F.lit(v) for v in explained]), F.col("component"))
    return found.select("id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                        share.alias("explained"), F.lit(error).alias("identity_error"))
