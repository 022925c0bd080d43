"""Exact dedup, quality rules, mixing and sharding against brute force, with skew and odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tabulon.llm import exact_dedup, mixing, quality_rules, sharding
from tabulon.llm.common import word_array

from tests.conftest import SF_MID

SPACE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, id int, row int, digest string, whole int, size int, key int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "d", 3, 4, 5) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    vocabulary = [f"w{k}" for k in range(300)]
    texts = [None, "", " ", "\t\n", "a b", "a  b", "a\nb", "a b ", "a b", "a b", "#*$%&|<> x", "漢字 漢字 漢字 漢字 漢字"]
    out = []
    for i in range(500):
        if i % 3 == 0:
            text = "one hot text that a third of all rows share"
        elif rng.random() < 0.4:
            text = rng.choice(texts)
        else:
            text = " ".join(rng.choices(vocabulary, k=rng.choice([1, 5, 60, 200])))
            text = text + "\n" + rng.choice(["", text, "line\nline", "*** ***"])
        out.append((rng.choice([i, i, i, None]), text, rng.choice(["en", "de", None]),
                    "hot" if i % 3 else rng.choice(["s1", "s2", "É", None])))
    out += [out[7]] * 5 + [(600, "z " * 30000, "en", "s1")]
    return out


@pytest.mark.parametrize("counters", [1, 4, 1024])
def test_exact_dedup(spark, rows, counters):
    docs = frame(spark, rows).repartition(5)
    group = defaultdict(list)
    for i, text, *_ in rows:
        group[SPACE.sub(" ", text or "")].append(i)
    want = Counter()
    for body, ids in group.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        want.update((i, keep, len(ids), hashlib.sha256(body.encode()).hexdigest()) for i in ids)
    marks = exact_dedup.mark_copies(docs, counters=counters).collect()
    assert Counter((r["id"], r["keep_id"], r["group_size"], r["digest"].hex()) for r in marks) == want
    assert Counter(r["digest"].hex() for r in marks if r["kept"]) == Counter(
        {hashlib.sha256(b.encode()).hexdigest(): 1 for b in group})
    assert all(r["id"] == r["keep_id"] for r in marks if r["kept"])
    stay = exact_dedup.drop_copies(docs, counters=counters)
    assert stay.columns == docs.columns
    assert sorted(SPACE.sub(" ", r["text"] or "") for r in stay.collect()) == sorted(group)


def test_heavy_digests_are_found_and_bounded(spark):
    rows = [(b"hot",)] * 400 + [(b"warm",)] * 150 + [(str(i).encode(),) for i in range(600)]
    random.Random(1).shuffle(rows)
    found = [r["digest"] for r in exact_dedup.heavy_digests(
        spark.createDataFrame(rows, "digest binary").repartition(6), 20).collect()]
    assert b"hot" in found and b"warm" in found and len(found) <= 20


def metrics(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_base_metrics(spark, rows):
    extra = [(900 + k, t, "en", "s1") for k, t in enumerate(["a b c a b c a", "x y z x y", "q q q q", "a b c d a b c e b c d"])]
    docs = frame(spark, rows + extra).repartition(4)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = quality_rules.apply_rules(docs).collect()
    assert Counter((r["id"], *(r[n] for n in names)) for r in got) == Counter((i, *metrics(t)) for i, t, *_ in rows + extra)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])


def test_word_array(spark):
    texts = ["", " ", "a", " a  b\t\x0b\x0c\r\nc ", "é x\x1cy"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(word_array(F.col("t"))).collect()]
    assert got == [WORD.findall(t) for t in texts]


def test_sketches_merge_and_bound_the_error(spark):
    rng = random.Random(3)
    values = [int(rng.lognormvariate(5, 2)) for _ in range(4000)]
    df = spark.createDataFrame([("en", f"s{i % 3}", v, 0, 0, 500, 10) for i, v in enumerate(values)],
                               "lang string, source string, symbol_share long, dup_line_share long, repeat_share long, "
                               "word_length long, n_words long")
    fine = quality_rules.sketch(df, ["lang", "source"])
    merged = quality_rules.merge(fine, ["lang"])
    direct = quality_rules.sketch(df.drop("source"), ["lang"])
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, direct.collect()))
    limits = quality_rules.fences(merged, ["lang"]).first()
    values.sort()
    q1, q3 = values[len(values) // 4 - 1], values[len(values) * 3 // 4 - 1]
    exact = q3 + quality_rules.K * max(q3 - q1, quality_rules.METRICS["symbol_share"])
    assert abs(limits["hi_symbol_share"] - exact) <= 7 * q3 / 32 + 1


def test_clean_documents_stay(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    judged = {r["id"]: r for r in quality_rules.apply_rules(docs).collect()}
    for r in labels.collect():
        if r["quality"] == 1 and not judged[r["doc_id"]]["base_failed"]:
            assert judged[r["doc_id"]]["kept"]
    bad = [judged[r["doc_id"]]["kept"] for r in labels.filter("quality = 0").collect()]
    assert sum(bad) <= 0.05 * len(bad)
    good = quality_rules.keep_good(docs)
    assert good.columns == docs.columns
    assert {r["doc_id"] for r in good.collect()} == {i for i, r in judged.items() if r["kept"]}


def test_targets_share_out(spark):
    sizes = {"a": 100, "b": 5, "c": 400, "d": 0, "e": 60, None: 35}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r for r in mixing.share_out(mixing.cycle_weights(df)).collect()}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while True:  # reshare until none is above
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= over
    for s in order:
        assert got[s]["weight"] == weight[s] and got[s]["target"] == pytest.approx(target[s])
    assert sum(r["target"] for r in got.values()) == pytest.approx(sum(sizes.values()))


def test_mixing(spark, rows):
    docs = frame(spark, rows).repartition(6)
    plan = mixing.plan_mix(docs).collect()
    assert len(plan) == len(rows)
    assert Counter((r["id"], r["source"], r["size"]) for r in plan) == Counter(
        (i, s, len(WORD.findall(t or ""))) for i, t, _, s in rows)
    taken, largest, target = Counter(), Counter(), {}
    for r in plan:
        assert 0 <= r["copies"] <= 3
        taken[r["source"]] += r["copies"] * r["size"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        target[r["source"]] = r["target"]
    for s, t in target.items():
        assert abs(taken[s] - t) <= 3 * largest[s]
    again = mixing.plan_mix(docs.repartition(2)).collect()
    assert Counter((r["id"], r["source"], r["size"], r["copies"]) for r in again) == Counter(
        (r["id"], r["source"], r["size"], r["copies"]) for r in plan)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    want = Counter()
    for r in plan:
        want[(r["id"], r["source"], r["size"])] += r["copies"]
    assert Counter((r["doc_id"], r["source"], len(WORD.findall(r["text"] or ""))) for r in mixed.collect()) == +want


def test_sharding(spark, rows):
    rng = random.Random(8)
    many = rows + [(10_000 + i, "x" * rng.choice([0, 10, 300, 3000]) + str(i), "en", "s") for i in range(4000)]
    docs = frame(spark, many).repartition(7)
    out = sharding.shard_records(docs, shards=8).select("record.doc_id", "record.text", "size", "shard", "slot").collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter((i, t) for i, t, *_ in many)
    sizes, slots = Counter(), defaultdict(list)
    for r in out:
        assert r["size"] == len((r["text"] or "").encode()) + 8
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert set(sizes) == set(range(8))
    assert max(sizes.values()) - min(sizes.values()) <= 0.08 * sum(sizes.values()) / 8 + 2 * 60008
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    again = sharding.shard_records(docs.repartition(3), shards=8).select("record.doc_id", "shard", "slot", "size")
    assert Counter((r["doc_id"], r["shard"]) for r in again.collect()) == Counter((r["doc_id"], r["shard"]) for r in out)


def test_overfull_ranges_are_subdivided(spark):
    """A third of all rows in one text: its run of equal hashes is cut by id."""
    rows = [(i, "hot text" if i % 3 == 0 else f"text {i}", "en", "s") for i in range(6000)]
    out = sharding.shard_records(frame(spark, rows), shards=6).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    sizes = [r["b"] for r in out]
    assert len(sizes) == 6 and max(sizes) <= 1.05 * sum(sizes) / 6


def test_equal_texts_share_a_shard_where_they_fit(spark):
    rows = [(i, f"text {i % 500}", "en", "s") for i in range(5000)]
    out = sharding.shard_records(frame(spark, rows), shards=5).select("record.text", "shard").distinct().collect()
    assert len(out) <= 500 + 5


def test_written_shards_read_back(spark):
    from tabulon.session import scratch_path

    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    path = scratch_path(spark, "shards")
    sharding.write_shards(sharding.shard_records(docs, shards=4), path)
    back = spark.read.parquet(path)
    assert {r["_shard"] for r in back.select("_shard").distinct().collect()} == {0, 1, 2, 3}
    assert back.select(*docs.columns).exceptAll(docs).isEmpty() and back.count() == docs.count()


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert exact_dedup.mark_copies(empty).count() == 0 and exact_dedup.drop_copies(empty).count() == 0
    assert quality_rules.apply_rules(empty).count() == 0 and quality_rules.keep_good(empty).count() == 0
    assert mixing.plan_mix(empty).count() == 0 and mixing.mix(empty).count() == 0
    assert sharding.shard_records(empty).count() == 0


def test_native_operators_run_no_python(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    for df in (quality_rules.apply_rules(docs), sharding.shard_records(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_crc(spark):
    docs = spark.createDataFrame([("é",), (None,)], "text string")
    got = [r[0] for r in docs.select(F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))).collect()]
    assert got == [zlib.crc32("é".encode()), 0]


def test_ties_do_not_depend_on_where_rows_lie(spark):
    """Rows that agree in id, text and source but not in other columns: the same ones stay and are
    taken, from any partitioning; a third of all rows may be one row."""
    rows = [(k % 4 if k % 5 else None, f"text {k % 3} " * (1 + k % 2), "en", "ab"[k % 2], k % 7, 0, "d", 0, 0, 0) for k in range(240)]
    rows += [(None, "the hot text", None, None, 1, 1, "d", 1, 1, 1)] * 150 + [(None, "the  hot\ttext", None, None, 0, 1, "d", 1, 1, 1)] * 20
    found = []
    for parts in (1, 7):
        docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        mixed = Counter(map(tuple, mixing.mix(docs).collect()))
        for counters in (1, 1024):
            stay = sorted(map(tuple, exact_dedup.drop_copies(docs, counters=counters).collect()), key=repr)
            assert len(stay) == len({SPACE.sub(" ", r[1]) for r in rows})
            found.append((stay, mixed))
    assert all(f == found[0] for f in found)
    plan = exact_dedup.drop_copies(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit", plan.index("Exchange hashpartitioning")) > 0  # below the shuffle, in every task
    taken = sum(n * len(WORD.findall(r[1])) for r, n in found[0][1].items())
    plan = mixing.plan_mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert taken == sum(r["copies"] * r["size"] for r in plan)
