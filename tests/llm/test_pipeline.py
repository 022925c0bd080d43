"""Every stage of the corpus pipeline against SQL or brute force, on its own input."""

import re
from collections import Counter

import duckdb

import corpus_pipeline as cp
from tabulon.llm.common import written
from tabulon.llm.queries import MIX_CTES, QUALITY_CTES
from tabulon.llm.unigram import Unigram, load_pieces

from tests.conftest import SF_MID
from tests.llm.test_jaccard import brute
from tests.llm.test_sentencepiece import sequential

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def test_stages(spark, model):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    columns = docs.columns
    frames = {}
    for name, stage in cp.STAGES:
        before = docs
        docs = written(stage(spark, docs, SF_MID), f"test_{name}")
        frames[name] = (before.toPandas(), docs.toPandas())
        if name != "sentencepiece":
            assert docs.columns == columns

    before, after = frames["quality_rules"]
    con = duckdb.connect()
    con.register("docs", before)
    kept = {r[0] for r in con.sql(f"WITH {QUALITY_CTES} SELECT doc_id FROM judged WHERE kept").fetchall()}
    assert set(after.doc_id) == kept and 0 < len(kept) < len(before)

    before, after = frames["exact_dedup"]
    first = {}
    for i, t in sorted(zip(before.doc_id, before.text, strict=True)):
        first.setdefault(SPACE.sub(" ", t), i)
    assert sorted(after.doc_id) == sorted(first.values()) and len(after) < len(before)

    before, after = frames["ngram_jaccard"]
    components = {c for _, c in brute(list(zip(before.doc_id, before.text, strict=True))).values()}
    assert set(after.doc_id) == components and len(after) < len(before)

    before, after = frames["mixing"]
    con.register("mixin", before)
    want = dict(con.sql(f"WITH {MIX_CTES} SELECT doc_id, copies FROM mixed WHERE copies > 0").fetchall())
    assert Counter(after.doc_id) == Counter(want)
    texts = dict(zip(before.doc_id, before.text, strict=True))
    assert all(texts[i] == t for i, t in zip(after.doc_id, after.text, strict=True))

    before, after = frames["sentencepiece"]
    vocab = Unigram(load_pieces(model))
    assert Counter(after.doc_id) == Counter(before.doc_id)
    texts = dict(zip(before.doc_id, before.text, strict=True))
    for i, ids, n in list(zip(after.doc_id, after.ids, after.n_tokens, strict=True))[::9]:
        assert list(ids) == sequential(vocab, texts[i]) and n == len(ids)


def test_run_gives_the_last_stage(spark):
    out = cp.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "n_tokens", "ids"] and out.count() > 0
