"""Centroid clustering of whole-number vectors with Ptolemaic pivot bounds.

For any four points, Ptolemy's inequality gives with two fixed pivots p and s

    d(q, o) >= |d(q, p) * d(o, s) - d(q, s) * d(o, p)| / d(p, s),

a lower bound of the distance from a vector q to a centroid o out of distances to the pivots. The
vectors' pivot distances never change: they are computed once and written beside the vectors; a
round only adds those of its few centroids.

* The starting centroids are the vectors of the smallest hashes of their ids (a top-k), the pivots
  some of them, each as far as possible from those before.
* In a round every task takes, for each vector, the largest bound over all pivot pairs, tries the
  centroid with the smallest bound exactly and then only those whose bound does not exceed the best
  distance so far. Bounds are rounded down by more than all floating point error, and only a bound
  strictly above the best distance rules a centroid out, so ties are met and the result is exact.
* A task adds up its vectors per cluster (one row per cluster and task); only the sums, clusters
  times dimensions, pass the driver. No row is ever shuffled by its cluster.

Defined results: kept are vectors of exactly ``dim`` entries, none of them null or non-finite;
entries whose whole number does not lie within ``LIMIT`` count as non-finite. Null ids hash as the
text "null"; of equal hashes (repeated ids) the smaller vector comes first. With fewer vectors than
clusters every vector is a centroid; equal centroids give their vectors to the smaller number. An
inertia beyond a long is null. An empty table gives an empty result. The input is read twice, so it
has to give the same rows again. Only the id and the vector are read, so further columns of any
name do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written
from .whitening import whole_numbers

PIVOTS = 4
LIMIT = 1 << 27
#: Rows whose bounds are computed at once.
CHUNK = 4096
#: More than the relative error of a bound, which takes some ten roundings of 2**-53.
SLACK = 2.0 ** -46


def squared(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of x to some points, exactly."""
    out = np.empty((len(x), len(points)), dtype=np.int64)
    for k, p in enumerate(points):
        d = x - p
        out[:, k] = np.einsum("ij,ij->i", d, d)
    return out


def far_pivots(points: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` different points: the first, then always the one farthest from those taken."""
    taken = [0]
    near = squared(points, points[:1])[:, 0]
    while len(taken) < count and near.max() > 0:
        taken.append(int(near.argmax()))
        near = np.minimum(near, squared(points, points[taken[-1:]])[:, 0])
    return points[taken]


def lower_bounds(to_pivots: np.ndarray, of_centroids: np.ndarray, between: np.ndarray) -> np.ndarray:
    """Lower bounds of the squared distances (rows x centroids) from squared pivot distances, rounded
    down: never above the true ones."""
    q, o, p = np.sqrt(to_pivots), np.sqrt(of_centroids), np.sqrt(between)
    best = np.zeros((len(q), len(o)))
    for a, b in combinations(range(len(p)), 2):
        one, two = q[:, a, None] * o[None, :, b], q[:, b, None] * o[None, :, a]
        low = (np.abs(one - two) - (one + two) * SLACK) / p[a, b]
        np.maximum(best, low, out=best)
    return best * best * (1 - 4 * SLACK)


def assign(x: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray,
           pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest centroid, its squared distance, number of exact distances computed); of equally near
    centroids the one with the smaller number."""
    rows = np.arange(len(x))
    low = lower_bounds(to_pivots, squared(centroids, pivots), squared(pivots, pivots))
    cluster = low.argmin(axis=1)
    d = x - centroids[cluster]
    best = np.einsum("ij,ij->i", d, d)
    tried = len(x)
    for k, centre in enumerate(centroids):
        open_to = rows[(low[:, k] <= best * (1 + SLACK)) & (cluster != k)]
        tried += len(open_to)
        d = x[open_to] - centre
        exact = np.einsum("ij,ij->i", d, d)
        nearer = (exact < best[open_to]) | ((exact == best[open_to]) & (k < cluster[open_to]))
        at = open_to[nearer]
        best[at], cluster[at] = exact[nearer], k
    return cluster, best, tried


def _vectors(dim: int, scale: int, pivots: np.ndarray | None):
    """(id, x) of the kept vectors, with their squared pivot distances if there are pivots."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, rows, x in whole_numbers(batch.column(1), scale, 0):
                inside = (np.abs(x) < LIMIT).all(axis=1)
                if length != dim or not inside.any():
                    continue
                rows, x = rows[inside], np.ascontiguousarray(x[inside])
                columns = [batch.column(0).take(pa.array(rows)), pa.array([v.tobytes() for v in x.astype(np.int32)], pa.binary())]
                names = ["id", "x"]
                if pivots is not None:
                    columns.append(pa.array([v.tobytes() for v in squared(x, pivots)], pa.binary()))
                    names.append("to_pivots")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, pivots: np.ndarray):
    """(ids, x, cluster, distance) of chunks of rows."""
    for batch in batches:
        for a in range(0, batch.num_rows, CHUNK):
            part = batch.slice(a, CHUNK)
            x = np.frombuffer(b"".join(part.column("x").to_pylist()), dtype=np.int32).reshape(part.num_rows, -1).astype(np.int64)
            q = np.frombuffer(b"".join(part.column("to_pivots").to_pylist()), dtype=np.int64).reshape(part.num_rows, -1)
            yield part.column("id"), x, *assign(x, q, centroids, pivots)[:2]


def _sums(centroids: np.ndarray, pivots: np.ndarray):
    """One row per cluster of a task: (cluster, n, sums)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(centroids), dtype=np.int64)
        sums = np.zeros(centroids.shape, dtype=np.int64)
        for _, x, cluster, _ in _assigned(batches, centroids, pivots):
            n += np.bincount(cluster, minlength=len(n))
            for k in np.unique(cluster):
                sums[k] += x[cluster == k].sum(axis=0)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some]),
                                          pa.array(sums[some].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    return run


def _labels(centroids: np.ndarray, pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, cluster, distance in _assigned(batches, centroids, pivots):
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(distance)],
                                             names=["id", "cluster", "distance"])

    return run


def starting_centroids(kept: DataFrame, clusters: int, salt: str) -> np.ndarray:
    """The vectors with the smallest sha256 of ``<salt>:<id>``, in that order."""
    name = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("id").cast("string"), F.lit("null")))
    first = kept.withColumn("hash", F.sha2(name.cast("binary"), 256)).orderBy("hash", "x").limit(clusters).collect()
    return np.array([np.frombuffer(r["x"], dtype=np.int32) for r in first], dtype=np.int64)


def moved(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centroids after one round: the floor of the exact mean of every cluster's vectors; empty
    clusters keep theirs."""
    dim = centroids.shape[1]
    parts = table.mapInArrow(_sums(centroids, pivots), "cluster int, n long, sums array<long>")
    totals = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(dim)]).alias("sums"))
    out = centroids.copy()
    for r in totals.collect():  # one row per cluster
        out[r["cluster"]] = [s // r["n"] for s in r["sums"]]
    return out


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = 16,
            rounds: int = 3, dim: int = 64, scale: int = 64, salt: str = "1", pivots: int = PIVOTS) -> DataFrame:
    """One row per kept vector: id, cluster, distance (squared), cluster_inertia, inertia,
    centroid_sha256. Entries are floor(scale * entry)."""
    spark = vectors.sparkSession
    slim = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("vector"))
    id_field, x_field = slim.schema["id"], T.StructField("x", T.BinaryType())
    labelled = T.StructType([id_field, T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    centroids = starting_centroids(slim.mapInArrow(_vectors(dim, scale, None), T.StructType([id_field, x_field])), clusters, salt)
    if not len(centroids):
        found, inertia, texts = spark.createDataFrame([], labelled), {}, []
    else:
        fixed = far_pivots(centroids, pivots)
        table = written(slim.mapInArrow(_vectors(dim, scale, fixed), T.StructType(
            [id_field, x_field, T.StructField("to_pivots", T.BinaryType())])), "pivot_vectors")
        for _ in range(rounds):
            centroids = moved(table, centroids, fixed)
        found = written(table.mapInArrow(_labels(centroids, fixed), labelled), "pivot_clusters")
        inertia = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(
            F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # one row per cluster
        texts = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]

    def long(value: int):
        return F.lit(value if value < 1 << 63 else None).cast("long")

    def per_cluster(values: list, kind: str):
        return F.element_at(F.array(*values), F.col("cluster") + 1) if values else F.lit(None).cast(kind)

    return found.select("id", "cluster", "distance",
                        per_cluster([long(inertia.get(k, 0)) for k in range(len(texts))], "long").alias("cluster_inertia"),
                        long(sum(inertia.values())).alias("inertia"),
                        per_cluster([F.lit(t) for t in texts], "string").alias("centroid_sha256"))
