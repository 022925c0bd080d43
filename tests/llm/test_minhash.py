"""MinHash components against brute force over all pairs, the posterior bounds and odd rows."""

import random
from math import comb

import numpy as np
import pytest

from tabulon.llm import minhash_dedup as mh
from tabulon.llm import near_groups
from tabulon.llm.shingles import U

from tests.conftest import SF_SMALL
from tests.llm.test_jaccard import brute, edited


def found(df):
    rows = df.collect()
    assert all(r["kept"] == (r["id"] is None or r["id"] == r["component_id"]) for r in rows)
    return {r["id"]: (r["n_shingles"], r["component_id"]) for r in rows}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(14)
    texts = [None, "", " \n", "one", "One", "one two", "a b c", "A b\tc", "a b d", "x " * 40_000, "x " * 39_000]
    for _ in range(40):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([4, 7, 9, 12, 20, 30, 60, 150, 400]))]
        for _ in range(rng.randrange(1, 9)):
            texts.append(" ".join(base))
            base = edited(rng, base, rng.choice([0.0, 0.005, 0.02, 0.05]))
    hub = [f"h{rng.randrange(5000)}" for _ in range(300)]
    texts += [" ".join(edited(rng, hub, 0.016)) for _ in range(150)]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("small", [False, True])
def test_components_are_those_of_all_pairs(spark, rows, monkeypatch, small):
    if small:  # shuffled id joins, groups in many blocks, texts in several cached stretches
        monkeypatch.setattr(near_groups, "BROADCAST_IDS", 0)
        monkeypatch.setattr(near_groups, "BLOCK", 9)
        monkeypatch.setattr(near_groups, "TASK_BYTES", 500)
        monkeypatch.setattr(mh, "CACHED", 64)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5 if small else 3)
    want = brute(rows, 3, 85)
    assert 30 < len({c for _, c in want.values()}) < len(want) - 100
    assert found(mh.near_duplicates(docs)) == want


def test_corpus_sample(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert found(mh.near_duplicates(docs)) == brute(rows, 3, 85)


def test_posterior_bounds_keep_what_they_promise():
    share = 0.85 + 0.15 / 256
    lost = 0
    for n in range(mh.BATCH, mh.HASHES + 1, mh.BATCH):
        m = mh.least_matches(n, 0.85, mh.MISS)
        # the posterior tail by numerical integration of the beta density
        x = np.linspace(0, 1, 200_001)
        for matches in (m - 1, m):
            density = x ** matches * (1 - x) ** (n - matches)
            tail = density[x >= share].sum() / density.sum()
            assert (tail >= mh.MISS) == (matches == m)
        lost += sum(comb(n, k) * share ** k * (1 - share) ** (n - k) for k in range(m))
    assert lost < 2e-5
    assert mh.least_matches(160, 0.85, 1e-6) > 0.68 * 160


def test_minima_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 63, 60_000, dtype=U) * U(2)
    for similarity in (0.5, 0.85):
        agree = []
        for k in range(120):
            part = pool[k * 500:(k + 1) * 500]
            common = int(400 * similarity)
            rest = (400 - common) // 2
            a, b = np.sort(part[:common + rest]), np.sort(np.concatenate([part[:common], part[common + rest:common + 2 * rest]]))
            owner = np.repeat([0, 1], [len(a), len(b)])
            least = mh.minima(owner, np.concatenate([a, b]), 2)
            agree.append((least[0] == least[1]).mean())
            assert (mh.band_keys(least)[0] == mh.band_keys(least)[1]).tolist() == (
                (least[0] == least[1]).reshape(mh.BANDS, mh.ROWS).all(axis=1)).tolist()
        assert abs(np.mean(agree) - similarity) < 0.015
        assert 0.5 < np.std(agree) / np.sqrt(similarity * (1 - similarity) / mh.HASHES) < 1.5


def test_nulls_repeats_and_empty(spark):
    schema = "doc_id long, text string, id string, n int, grp int, shingles int, sketch int, bands int, kept int"
    assert mh.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    text = "the same eight words make up this text"
    rest = (None, 0, 0, 0, 0, 0, 0)
    rows = [(None, text, *rest), (3, text, *rest), (3, text, *rest), (2, text, *rest), (4, None, *rest)]
    out = mh.near_duplicates(spark.createDataFrame(rows, schema))
    got = sorted((r["id"] or 0, r["component_id"] or 0, r["kept"]) for r in out.collect())
    assert got == [(0, 0, True), (2, 2, True), (3, 2, False), (3, 2, False), (4, 4, True)]
