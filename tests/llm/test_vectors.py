"""Whitening and centroid clustering against brute force."""

import hashlib
import math

import numpy as np
import pytest

from tabulon.llm import pivot_clusters as pc
from tabulon.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>, id int, x int, block int, cluster int, label int"
ODD = [None, [], [1.0], [0.5, None, 0.25], [0.5, float("nan"), 0.25], [float("inf"), 0.0, 0.0], [1e30, 0.0, 0.0],
       [0.0, 0.0, 0.0, 0.0]]


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4, 5) for i, v in rows], SCHEMA).repartition(parts)


def vectors(n, dim, seed=1):
    rng = np.random.default_rng(seed)
    x = (rng.normal(size=(n, dim)) @ rng.normal(size=(dim, dim)) * 0.3).astype(np.float32)
    x[: n // 3] = x[0]  # a third of the rows are the same vector
    return [(k if k % 11 else None, v.tolist()) for k, v in enumerate(x)]


def whole(v, scale, shift):
    return [math.floor(scale * float(np.float32(c))) + shift for c in v]


@pytest.mark.parametrize("per_block", [8, 1024])
def test_whitening_is_that_of_a_dense_computation(spark, monkeypatch, per_block):
    monkeypatch.setattr(wh, "BLOCKS_PER_SPLIT", 3)
    rows = vectors(300, 12)
    out = wh.whiten(frame(spark, rows, 5), rows_per_block=per_block).toPandas()
    x = np.array([whole(v, 1024, 100_000) for _, v in rows], dtype=object)
    n, s = len(x), x.sum(axis=0)
    assert len(out) == 8 * n and set(out.n) == {n} and set(out.component) == set(range(1, 9))
    deviation = sorted(int(((n * r - s) ** 2).sum()) for r in x)
    assert sorted(out[out.component == 1].deviation) == deviation
    centred = ((n * x - s) / n).astype(float)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    explained = out.groupby("component").explained.first().to_numpy()
    assert np.allclose(explained, values[:8] / values.sum(), rtol=1e-9)
    assert out.identity_error.nunique() == 1 and out.identity_error[0] < 1e-9
    want = centred @ axes[:, :8] / np.sqrt(values[:8])
    for k in range(8):  # either sign, the same for all rows
        got = np.sort(out[out.component == k + 1].whitened.to_numpy())
        assert min(np.abs(got - np.sort(sign * want[:, k])).max() for sign in (1, -1)) < 1e-8
    one = out[out.id == 1]
    assert np.allclose(np.abs(one.sort_values("component").whitened), np.abs(want[1]), atol=1e-8)


def test_whitening_of_odd_rows(spark):
    good = [(1, [0.5, 0.25, -1.0]), (2, [0.0, 0.25, 1.0]), (2, [0.0, 0.25, 1.0]), (None, [0.1, 0.25, 0.2])]
    out = wh.whiten(frame(spark, good + [(9, v) for v in ODD])).collect()
    assert sorted({r["id"] or 0 for r in out}) == [0, 1, 2] and len(out) == 4 * 3 and {r["n"] for r in out} == {4}
    # the second entry is constant and two rows span the rest with the third: two components at most have variance
    assert {r["component"] for r in out if r["whitened"] is None} == {3}
    assert out[0]["identity_error"] < 1e-9
    assert wh.whiten(frame(spark, [(9, v) for v in ODD[:2]] + [(1, [float("nan")])])).count() == 0
    assert wh.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    alone = wh.whiten(frame(spark, [(1, [0.5, 0.25])])).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"]) for r in alone] == [(1, 0, None, 0.0)] * 2


def test_deviations_beyond_a_long_are_null(spark):
    far = [(k, [1e8 * (k % 2), 0.0]) for k in range(40)]
    out = wh.whiten(frame(spark, far)).collect()
    assert {r["deviation"] for r in out} == {None} and out[0]["identity_error"] < 1e-9


def lloyd(rows, clusters, rounds, scale=64):
    kept = [(i, whole(v, scale, 0)) for i, v in rows]
    name = {i: hashlib.sha256(f"1:{'null' if i is None else i}".encode()).hexdigest() for i, _ in kept}
    start = sorted(kept, key=lambda r: (name[r[0]], np.array(r[1], dtype=np.int32).tobytes()))
    centroids = [v for _, v in start[:clusters]]

    def nearest(v):
        d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        of = [nearest(v)[0] for _, v in kept]
        for k in range(len(centroids)):
            own = [v for (_, v), c in zip(kept, of) if c == k]
            if own:
                centroids[k] = [sum(col) // len(own) for col in zip(*own)]
    last = [(i, *nearest(v)) for i, v in kept]
    inertia = [sum(d for _, c, d in last if c == k) for k in range(len(centroids))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((i or 0, c, d, inertia[c], sum(inertia), sha[c]) for i, c, d in last)


def found(df):
    return sorted((r["id"] or 0, r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"])
                  for r in df.collect())


@pytest.mark.parametrize("clusters, rounds", [(16, 3), (5, 0), (1, 2)])
def test_clusters_are_those_of_plain_rounds(spark, clusters, rounds):
    rows = vectors(260, 7, seed=3)
    out = pc.cluster(frame(spark, rows, 4), clusters=clusters, rounds=rounds, dim=7)
    assert found(out) == lloyd(rows, clusters, rounds)


def test_clusters_of_ties_few_and_odd_rows(spark):
    ties = [(k, [float(k % 3), 0.0, 0.0]) for k in range(9)] + [(2, [2.0, 0.0, 0.0])]
    assert found(pc.cluster(frame(spark, ties + [(9, v) for v in ODD]), dim=3)) == lloyd(ties, 16, 3)
    assert pc.cluster(spark.createDataFrame([], SCHEMA)).count() == 0
    assert pc.cluster(frame(spark, [(9, v) for v in ODD]), dim=64).count() == 0


def test_bounds_are_below_the_distances_and_prune():
    rng = np.random.default_rng(5)
    centres = rng.integers(-5000, 5000, (16, 8))
    x = centres[rng.integers(0, 16, 3000)] + rng.integers(-40, 41, (3000, 8))
    pivots = pc.far_pivots(centres, 4)
    low = pc.lower_bounds(pc.squared(x, pivots), pc.squared(centres, pivots), pc.squared(pivots, pivots))
    exact = pc.squared(x, centres)
    assert (low <= exact).all()
    cluster, best, tried = pc.assign(x, pc.squared(x, pivots), centres, pivots)
    assert (cluster == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()
    assert tried < 2 * len(x)  # of 16 each
    # a pivot that equals the vector or the centroid gives the distance itself: rounding must not exceed it
    many = pc.lower_bounds(pc.squared(pivots, pivots), pc.squared(centres, pivots), pc.squared(pivots, pivots))
    assert (many <= pc.squared(pivots, centres)).all()
