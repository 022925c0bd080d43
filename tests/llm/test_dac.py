"""Directly addressable codes: the library's ids, the packed levels and random access."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabulon.llm import dac_tokens
from tabulon.llm.byte_bpe import ByteBPE
from tabulon.session import scratch_path

from tests.conftest import SF_SMALL

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  ", "\n", " \n x", "don't they'll we've 'tis ''s 's\n's x's", "a  b   c\t\td\r\n\r\n e ", "x1y22 33z",
       "…漢字 mixed", "tail   ", "a b \u0085c", "¿qué? ¡sí! — né", "it's'll'd'mx're", "<|endoftext|> x", " '", "a'", "'",
       "1st 2nd's", "ǅ ŉ ª º ² ¼", "\x00\x01 \x1c\x1d"]


@pytest.fixture(scope="module")
def bpe():
    with open(PATH, encoding="utf-8") as f:
        return ByteBPE(f.read())


def library(texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(PATH)
    return [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_ids_are_the_librarys(bpe):
    rng = random.Random(3)
    noise = ["".join(rng.choice(" \n\t'sStrevmld aé1²,. 漢") for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts = ODD + noise
    for text, mine, theirs in zip(texts, bpe.encode(texts), library(texts), strict=True):
        assert mine.tolist() == theirs, repr(text)
    every = "".join(map(chr, range(1, 0x250)))
    texts = [every] + [f"a{c} {c}b 1{c}{c} {c}" for c in every]
    assert [x.tolist() for x in bpe.encode(texts)] == library(texts)


def thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word[:n]


def test_pre_tokens_that_defeat_polynomial_hashes(bpe):
    words = [w for n in (1024, 2048) for t in [thue_morse(n)] for w in (t, t.translate(str.maketrans("ab", "ba")))]
    for batch in ([" ".join(words)], words, words[::-1]):  # in one batch, and against remembered ones
        assert [x.tolist() for x in bpe.encode(batch)] == library(batch)


def test_pre_tokens_that_share_a_hash(bpe, monkeypatch):
    """Equal hashes are no equal pre-tokens: neither within a batch nor against earlier ones."""
    with open(PATH, encoding="utf-8") as f:
        other = ByteBPE(f.read())
    other.hashes = lambda raw, a, b: (b - a).astype(np.uint64)
    for batch in (["one two", "six ten"], ["one"], ["two"], ["six"], ["one"]):
        assert [x.tolist() for x in other.encode(batch)] == library(batch)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500))
def test_levels_round_trip(values):
    ids = np.array(values, dtype=np.uint32)
    levels = dac_tokens.pack(ids)
    assert dac_tokens.unpack(levels).tolist() == values
    at = np.arange(len(ids))[::7]
    assert dac_tokens.access(levels, at).tolist() == ids[at].tolist()


@pytest.mark.parametrize("segment_tokens", [50, 1 << 20])
def test_files_against_brute_force(spark, segment_tokens):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    extra = [(10_000 + i, t) for i, t in enumerate([*ODD, None])] + [(5, "again"), (None, "no id")]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).repartition(6)
    path = scratch_path(spark, "tokens")
    dac_tokens.write_tokens(docs, path, PATH, end_id=2, segment_tokens=segment_tokens, batch_chars=5000)
    rows = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in docs.collect()))
    ids = [x + [2] for x in library([r[2] for r in rows])]
    want, start = [], 0
    for (no_id, name, _), own in zip(rows, ids, strict=True):
        want.append((start, None if no_id else name, len(own), zlib.crc32(np.array(own, dtype="<u4").tobytes())))
        start += len(own)
    got = sorted((r["start"], r["id"], r["n_tokens"], r["ids_crc32"]) for r in dac_tokens.read_documents(spark, path).collect())
    assert got == want
    flat = [t for own in ids for t in own]
    at = random.Random(1).sample(range(len(flat)), 200)
    asked = spark.createDataFrame([(p,) for p in [*at, len(flat) + 9]], "position long")
    found = {r["position"]: r["token"] for r in dac_tokens.read_tokens(asked, path).collect()}
    assert found == {p: flat[p] for p in at}


def test_empty_table(spark):
    path = scratch_path(spark, "tokens")
    empty = spark.createDataFrame([], "doc_id long, text string, ids int, part int, segment int")
    dac_tokens.write_tokens(empty, path, PATH, end_id=2)
    assert dac_tokens.read_documents(spark, path).count() == 0
