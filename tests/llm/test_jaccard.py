"""The near-duplicate join against brute force over all pairs."""

import random
import re

import numpy as np
import pytest

from tabulon.llm import jaccard_join as jj
from tabulon.llm import near_groups, shingles as hashing
from tabulon.llm.components import connected_components
from tabulon.llm.shingles import U, shingle_sets

from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def shingles(text, width=5):
    w = words(text)
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def brute(rows, width=5, similarity=80):
    sets = [(i, shingles(t, width)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= similarity * len(a | b):
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    return {i: (len(a), top(i)) for i, a in sets}


def edited(rng, base, rate):
    out = list(base)
    for k in range(len(out)):
        if rng.random() < rate:
            out[k] = rng.choice("xyz") + str(rng.randrange(1000))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    texts = [None, "", " \n", "one", "One", "one two three four", "a b c d e", "A b\tc d  e", "a b c d f"]
    for _ in range(40):  # chains and clusters of every size, down to a few words
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([6, 7, 9, 12, 20, 30, 60, 150, 400]))]
        for _ in range(rng.randrange(1, 9)):
            texts.append(" ".join(base))
            base = edited(rng, base, rng.choice([0.0, 0.005, 0.02, 0.05]))
    hub = [f"h{rng.randrange(5000)}" for _ in range(300)]
    texts += [" ".join(edited(rng, hub, 0.012)) for _ in range(120)]
    rng.shuffle(texts)
    return list(enumerate(texts))


def found(df):
    return {r["id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_components_are_those_of_all_pairs(spark, rows, monkeypatch):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows)
    assert len({c for _, c in want.values()}) < len(want) - 100
    assert found(jj.near_duplicates(docs)) == want
    kept = {r["doc_id"] for r in jj.keep_one(docs).collect()}
    assert kept == {c for _, c in want.values()}


def test_combined_keys_large_groups_and_shuffled_id_joins(spark, rows, monkeypatch):
    monkeypatch.setattr(near_groups, "BROADCAST_IDS", 0)
    monkeypatch.setattr(jj, "COMBINE", 3)
    monkeypatch.setattr(near_groups, "BLOCK", 7)
    monkeypatch.setattr(near_groups, "TASK_BYTES", 500)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert found(jj.near_duplicates(docs)) == brute(rows)


def test_corpus_sample(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert found(jj.near_duplicates(docs)) == brute(rows)


def test_pigeonhole_never_loses_a_pair():
    """Every pair that may link shares a key, one side probing and the other indexing."""
    rng = np.random.default_rng(2)
    bounds = jj.band_bounds()
    for trial in range(1500):
        n = int(rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 10, 13, 18, 27, 40, 64, 90, 200, 500]))
        pool = rng.integers(0, 1 << 63, 2 * n, dtype=U) * U(2)
        if trial % 3 == 0:  # hashes that crowd in few segments
            pool = (pool >> U(12)) | (U(5) << U(60))
        a, more = pool[:n], pool[n:]
        cut, add = int(rng.integers(0, n // 5 + 1)), int(rng.integers(0, n // 4 + 1))
        b = np.unique(np.concatenate([a[cut:], more[:add]]))
        a = np.unique(a)
        inter = len(np.intersect1d(a, b))
        if 100 * inter < 80 * (len(a) + len(b) - inter) or not inter:
            continue
        owner = np.repeat([0, 1], [len(a), len(b)])
        sizes = np.array([len(a), len(b)])
        seen, spares = {}, {}
        with np.errstate(over="ignore"):
            for below in range(3):
                for who, key, flag, spare in zip(*jj.signatures(owner, np.concatenate([a, b]), sizes, bounds, below), strict=True):
                    sides = seen.setdefault(int(key), {})
                    sides[int(who)] = (sides.get(int(who), (0, 0))[0] | int(flag), below)
                    spares[int(who), below] = int(spare)
        # one side probes, the other indexes, and not all such keys may be left out
        met = {}
        for sides in seen.values():
            for r, other in ((0, 1), (1, 0)):
                if r in sides and other in sides and sides[r][0] & jj.PROBE and sides[other][0] & jj.INDEX:
                    met[r, sides[r][1]] = met.get((r, sides[r][1]), 0) + 1
        assert any(n > spares[k] for k, n in met.items()), (len(a), len(b), met)


def test_shingle_sets_sizes():
    texts = ["a b c d e f", "", "  ", "x", "x x x x x x x", "É é", "A B", "a b"]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    owner, hashed = shingle_sets(np.frombuffer(b"".join(raw), dtype=np.uint8), offsets)
    assert np.bincount(owner, minlength=len(texts)).tolist() == [len(shingles(t)) for t in texts]
    assert hashed[owner == 6].tolist() == hashed[owner == 7].tolist()


def thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word[:n]


def test_words_that_defeat_polynomial_hashes_stay_apart(spark):
    rows = []
    for k, n in enumerate((1024, 2048, 4096)):
        word = thue_morse(n)
        rows += [(2 * k, word), (2 * k + 1, word.translate(str.maketrans("ab", "ba")))]
    assert found(jj.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == {i: (1, i) for i, _ in rows}


def test_span_hashes_and_equal_spans():
    rng = random.Random(8)
    spans = [bytes(rng.choice(b"ab") for _ in range(rng.choice([0, 1, 7, 8, 9, 16, 17, 40, 511, 512, 513, 2000]))) for _ in range(600)]
    spans += [s[:-1] + bytes([s[-1] ^ 1]) for s in spans if s] + spans[:50]
    raw = np.frombuffer(b"".join(spans), dtype=np.uint8)
    b = np.cumsum([len(s) for s in spans])
    a = b - [len(s) for s in spans]
    names = hashing.span_hashes(raw, a, b).tolist()
    assert len(set(names)) == len(set(spans)) and len(set(zip(names, spans))) == len(set(spans))
    pairs = [(i, j) for i in range(0, len(spans), 7) for j in range(len(spans)) if len(spans[i]) == len(spans[j])]
    i, j = np.array(pairs).T
    same = hashing.same_spans(raw, a[i], raw, a[j], (b - a)[i])
    assert same.tolist() == [spans[x] == spans[y] for x, y in pairs]


def test_a_long_text_in_pieces(monkeypatch):
    monkeypatch.setattr(hashing, "PIECE", 64)
    rng = random.Random(3)
    text = " ".join(rng.choice(["x", "Yy", "zzz" * 40, "q\tq", "\n"]) for _ in range(3000)).encode()
    whole = hashing.words_of(np.frombuffer(text, dtype=np.uint8), np.array([0, len(text)]))[3]
    owner, pieces = hashing.word_hashes(np.frombuffer(text, dtype=np.uint8), np.array([0, len(text)]))
    assert pieces.tolist() == whole.tolist() and not owner.any()


def test_parity_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(6)
    for n in (1, 3, 16, 17, 150, 900):
        pool = rng.integers(0, 1 << 63, 2 * n, dtype=U)
        for shift in range(0, n + 1, max(1, n // 7)):
            a, b = np.unique(pool[:n]), np.unique(pool[shift:n + 2 * shift])
            sizes = np.array([len(a), len(b)])
            one, two = jj.folded(jj.parity_sketches(np.concatenate([a, b]), sizes))
            differ = len(np.setxor1d(a, b))
            seen = int(np.bitwise_count(one ^ two).sum())
            assert seen <= differ and (differ - seen) % 2 == 0 and (not differ or seen > 0 or differ > 1)


def test_a_family_whose_members_mostly_stay_apart(spark, monkeypatch):
    """Links are rare among texts that share most words: groups stay open and are worked on in blocks."""
    monkeypatch.setattr(near_groups, "BLOCK", 40)
    rng = random.Random(12)
    base = [f"b{k}" for k in range(120)]
    rows = [(k, " ".join(edited(rng, base, 0.035))) for k in range(200)]
    want = brute(rows)
    assert 20 < len({c for _, c in want.values()}) < 190
    assert found(jj.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))) == want


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}


def test_nulls_repeats_and_empty(spark):
    schema = "doc_id long, text string, id string, n int, grp int, shingles int"
    assert jj.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    text = "the same eight words make up this text"
    rows = [(None, text, None, 0, 0, 0), (3, text, "x", 1, 1, 1), (3, text, "x", 1, 1, 1), (2, text, None, 0, 0, 0)]
    got = sorted(((r["id"] or 0, r["component_id"]) for r in jj.near_duplicates(spark.createDataFrame(rows, schema)).collect()),
                 key=lambda x: x[0])
    assert got == [(0, None), (2, 2), (3, 2), (3, 2)]
