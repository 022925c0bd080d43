"""Boosted trees: held-out accuracy, flattened traversal against plain walking, edge cases."""

import zlib

import numpy as np
import pytest

from tabulon.llm import quality_gbt as q

from tests.conftest import SF_MID


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    scored = {r["id"]: r for r in q.score_documents(docs, labels).collect()}
    assert len(scored) == docs.count()
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    for i, r in scored.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r["score"] <= 1
    held = [(scored[i]["score"] >= 0.5) == (y == 1) for i, y in truth.items() if scored[i]["held_out"]]
    assert len(held) > 80 and sum(held) / len(held) > 0.97
    # labels of the held-out fold are never looked at
    from pyspark.sql import functions as F

    flipped = labels.withColumn("quality", F.when(q.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r["id"]: r["score"] for r in q.score_documents(docs, flipped).collect()}
    assert again == {i: r["score"] for i, r in scored.items()}


def test_flattened_traversal_equals_walking():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 6)).astype(np.float32)
    y = ((x[:, 0] * x[:, 1] > 0) ^ (x[:, 2] > 1)).astype(float)
    model = q.fit(x, y, trees=25)
    assert ((model.scores(x) >= 0.5) == (y == 1)).mean() > 0.9

    def walk(row):
        total = model.prior
        for s, limit, leaf in zip(model.statistic, model.limit, model.leaf, strict=True):
            k = 0
            while k < len(s):
                k = 2 * k + 1 + int(row[s[k]] > limit[k])
            total += leaf[k - len(s)]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(model.scores(x), [walk(r) for r in x])


def test_statistics_of_known_texts():
    texts = ["", "ONE two\nONE two\n", "a#b c", "é é é é"]
    raw = [t.encode() for t in texts]
    x = q.statistics(np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum([0, *map(len, raw)]))
    at = {n: k for k, n in enumerate(q.STATISTICS)}
    assert not x[0].any()
    assert x[1, at["distinct_lines"]] == 0.5 and x[1, at["distinct_words"]] == 0.5 and x[1, at["shouted_words"]] == 0.5
    assert x[2, at["symbol"]] == pytest.approx(0.2) and x[3, at["distinct_windows"]] == 0.5
    alone = [q.statistics(np.frombuffer(r, dtype=np.uint8), np.array([0, len(r)])) for r in raw]
    assert np.array_equal(np.vstack(alone), x)


def test_nulls_no_labels_and_empty(spark):
    docs = spark.createDataFrame([(None, None, 1), (1, "", 2), (1, "word " * 20000, 3), (2, "x y", 4)],
                                 "doc_id long, text string, x int")
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    assert [r["score"] for r in q.score_documents(docs, none).collect()] == [0.5] * 4
    one = spark.createDataFrame([(2, 1), (2, 1)], "doc_id long, quality int")
    assert all(0 < r["score"] < 1 for r in q.score_documents(docs, one).collect())
    assert q.score_documents(docs.limit(0), one).count() == 0
