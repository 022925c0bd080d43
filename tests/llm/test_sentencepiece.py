"""Unigram segmentation: the trie, the chunked scan and the counts against the plain sequential
algorithm, the library as a bound on the score, and exact round trips."""

import random

import pytest

from tabulon.llm import sentencepiece_scan as scan
from tabulon.llm import token_counts
from tabulon.llm.unigram import Unigram, load_pieces

from tests.conftest import SF_MID

ODD = ["", None, " ", "\n", "a", "  two  spaces ", "line\nbreak\n\n", "tab\tand\rfeed", "naïve 漢字 🙂 ▁x",
       "x" * 300, "abcdefghij" * 60 + " tail", "漢" * 90 + "the end" * 20, "the the the\x00the"]


def sequential(vocab, text):
    prepared = vocab.prepared(text or "")
    best, back = vocab.forward(prepared, [0], len(prepared))
    return vocab.path(prepared, back, len(prepared))[0]


@pytest.fixture(scope="module")
def vocab(model):
    return Unigram(load_pieces(model))


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_MID}/documents.parquet").select("text").limit(60).collect()
    rng = random.Random(5)
    noise = ["".join(rng.choice("abthein \n漢é") for _ in range(rng.randrange(0, 400))) for _ in range(40)]
    return ODD + [r["text"] for r in rows] + noise


def test_trie_equals_sequential_algorithm(vocab, texts):
    units = sorted({u for t in texts for u in vocab.units(vocab.prepared(t or ""))})
    counts, scores, offsets, flat = vocab.solve(units)
    for k, unit in enumerate(units):
        best, back = vocab.forward(unit, [0], len(unit))
        assert scores[k] == best[-1]
        assert flat[offsets[k]:offsets[k] + counts[k]].tolist() == vocab.path(unit, back, len(unit))[0]


@pytest.mark.parametrize("chunk", [7, 50, 1000])
def test_chunk_size_does_not_matter(spark, model, vocab, texts, chunk):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r["id"]: r for r in scan.encode(docs, model, chunk_chars=chunk, batch_chars=500).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert got[i]["ids"] == sequential(vocab, text), (i, text[:40])
    if chunk == 7:
        assert max(r["n_chunks"] for r in got.values()) > 64  # more than one block of the scan


def test_blocks_without_any_safe_place(spark, model, vocab):
    text = "ab" * 1200  # one unit: every boundary has many states, several blocks
    docs = spark.createDataFrame([(1, text), (2, text + " x")], "doc_id long, text string")
    for r in scan.encode(docs, model, chunk_chars=16).collect():
        assert r["ids"] == sequential(vocab, text if r["id"] == 1 else text + " x")


def test_round_trip(spark, model, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    back = scan.decode(scan.encode(docs, model), model).collect()
    for r in back + scan.encode(docs, model, chunk_chars=200, decoded=True).collect():
        assert r["text"] == (texts[r["id"]] or "").replace("▁", " ")


def test_never_scores_below_the_library(vocab, model):
    sentencepiece = pytest.importorskip("sentencepiece")
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    proto = pb.ModelProto()
    with open(model, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1  # the same pieces and scores as a unigram model
    sp = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    words = "the heading of another then thereafter nation station einheit wissenschaft rétention".split()
    for w in words + [a + b for a in words for b in words]:
        mine, theirs = sequential(vocab, w), sp.encode(w)
        assert sum(vocab.fixed[mine]) >= sum(vocab.fixed[theirs])
        assert sp.decode(mine) == w


def test_counts_are_the_lengths_of_the_encoding(spark, model, vocab, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for limit in (40, token_counts.BATCH_CHARS):
        counts = {r["id"]: r["n_tokens"] for r in token_counts.count_tokens(docs, model, batch_chars=limit).collect()}
        assert counts == {i: len(sequential(vocab, t)) for i, t in enumerate(texts)}


def test_empty_table_and_clashing_columns(spark, model):
    schema = "doc_id long, text string, id string, ids int, row int, k int, n_tokens int"
    empty = spark.createDataFrame([], schema)
    assert scan.encode(empty, model).count() == 0
    assert token_counts.count_tokens(empty, model).count() == 0
    one = spark.createDataFrame([(None, "the same", "x", 1, 2, 3, 4)] * 2, schema)
    encoded = scan.encode(one, model).collect()
    assert [r["id"] for r in encoded] == [None, None] and encoded[0]["ids"] == encoded[1]["ids"]
    counts = token_counts.count_tokens(one, model).collect()
    assert [r["n_tokens"] for r in counts] == [len(encoded[0]["ids"])] * 2
