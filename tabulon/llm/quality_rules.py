"""Quality rules with adaptive thresholds.

Two base rules reject outright: fewer than ``MIN_WORDS`` words, or more than half of the words in
3-word windows that the text repeats. For the other rules each metric's
distribution is sketched per language and source, and a document fails where it lies outside the
fences that its own group's sketch gives: Q1 - K * spread and Q3 + K * spread, spread = Q3 - Q1 but
at least the metric's least spread in ``METRICS``. For metrics that are 0 in most documents that
constant decides the fence (see the README for counts).

The sketch is a log-linear histogram of integers: a value keeps its ``SKETCH_BITS`` leading bits
(relative error below 2^-5), and a sketch is the count per kept value. Sketches merge by adding
counts, so one aggregation with map-side combining builds all of them, the sketch of a language is
the sum of its sources' and that of the corpus the sum of those. A group of fewer than
``MIN_GROUP`` documents takes the fences of its language, a language of fewer takes the corpus'.
Sketches take in every document with a word.

Everything is DataFrame functions. The text is read once; metrics go to a written table, from
which the sketches and the verdict are made. The fences (one row per language and source) are
broadcast when they are at most ``BROADCAST_GROUPS`` rows by count, else joined by shuffle.

A text is one value of a task, with its words and windows as arrays beside it (some tens of bytes
for a word): very long texts need that much of one task's memory.

Defined results: a null text has no words and fails. Null languages and sources are groups of
their own. Repeated rows are judged alike. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import spaces_only, text_or_empty, word_array, written

MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
SKETCH_BITS = 6
#: Spreads from the quartile to the fence.
K = 3
MIN_GROUP = 200
BROADCAST_GROUPS = 50_000
#: Metric -> least spread, in the metric's unit. Shares are per thousand words or lines, the mean
#: word length is in hundredths of a character.
METRICS = {"symbol_share": 20, "dup_line_share": 120, "repeat_share": 150, "word_length": 60}
#: Metrics that also have a lower fence.
TWO_SIDED = ("word_length",)


def base_metrics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words (all long) to
    ``docs``; columns of these names must not exist.

    3-word windows are told apart by 64-bit hashes. Only texts with an equal pair of windows are
    sorted by (hash, position); positions next to an equal hash are the repeated windows, and each
    of them adds its words up to the next repeated one."""
    text = F.col("_text")
    no_symbols = text
    for symbol in SYMBOLS:
        no_symbols = F.replace(no_symbols, F.lit(symbol), F.lit(""))
    out = (docs.withColumn("_text", text_or_empty(text_col))
           .withColumn("_words", word_array(text))
           .withColumn("_lines", F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
           .withColumn("n_words", F.size("_words").cast("long"))
           .withColumn("word_chars", F.length(F.replace(spaces_only(text), F.lit(" "), F.lit(""))).cast("long"))
           .withColumn("n_symbols", (F.length(text) - F.length(no_symbols)).cast("long"))
           .withColumn("n_lines", F.size("_lines").cast("long"))
           .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
           .withColumn("_hashes", F.when(F.size("_words") >= 3, F.transform(
               F.sequence(F.lit(0), F.size("_words") - 3),
               lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)))))
           .withColumn("_sorted", F.when(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), F.sort_array(
               F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
           .withColumn("_repeated", F.sort_array(F.transform(F.filter("_sorted", lambda x, k:
               x["h"].eqNullSafe(F.get("_sorted", k - 1)["h"]) | x["h"].eqNullSafe(F.get("_sorted", k + 1)["h"])),
               lambda x: x["i"])))
           .withColumn("n_repeat_words", F.coalesce(F.aggregate(
               F.transform("_repeated", lambda p, k: F.least(
                   F.lit(3), F.coalesce(F.get("_repeated", k + 1), p + 3) - p)),
               F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")))
    return out.drop("_text", "_words", "_lines", "_hashes", "_sorted", "_repeated")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def add_rule_metrics(df: DataFrame) -> DataFrame:
    """The integer metrics that the adaptive rules judge; null without words."""
    share = {"symbol_share": ("1000 * n_symbols", "n_words"), "dup_line_share": ("1000 * n_dup_lines", "n_lines"),
             "repeat_share": ("1000 * n_repeat_words", "n_words"), "word_length": ("100 * word_chars", "n_words")}
    for name, (a, b) in share.items():
        df = df.withColumn(name, F.expr(f"case when n_words > 0 then {a} div {b} end"))
    return df


def sketch(df: DataFrame, keys: list[str], metrics=tuple(METRICS)) -> DataFrame:
    """(keys..., metric, bucket, n): the mergeable sketches of all groups and metrics."""
    long = df.filter("n_words > 0").select(*keys, F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics])))
    dropped = F.greatest(F.length(F.bin("value")) - SKETCH_BITS, F.lit(0))
    bucket = F.call_function("shiftleft", F.call_function("shiftright", F.col("value"), dropped), dropped)
    return long.groupBy(*keys, "metric", bucket.alias("bucket")).agg(F.count("*").alias("n"))


def merge(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of coarser groups: counts add up."""
    return sketches.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))


def fences(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., group_rows, lo_<metric>, hi_<metric> ...) from the quartiles of each sketch. The
    window runs over a sketch's buckets, whose number is bounded by the metric's range."""
    group = Window.partitionBy(*keys, "metric")
    upto = F.sum("n").over(group.orderBy("bucket"))
    rows = F.sum("n").over(group)
    quartile = {q: F.min(F.when(F.col("upto") * 100 >= F.col("rows") * q, F.col("bucket"))) for q in (25, 75)}
    q = (sketches.withColumn("upto", upto).withColumn("rows", rows).groupBy(*keys, "metric")
         .agg(F.max("rows").alias("rows"), quartile[25].alias("q1"), quartile[75].alias("q3")))
    columns = [F.max("rows").alias("group_rows")]
    for m, least in METRICS.items():
        spread = F.greatest(F.col("q3") - F.col("q1"), F.lit(least)) * K
        columns.append(F.max(F.when(F.col("metric") == m, F.col("q3") + spread)).alias(f"hi_{m}"))
        if m in TWO_SIDED:
            columns.append(F.max(F.when(F.col("metric") == m, F.col("q1") - spread)).alias(f"lo_{m}"))
    return q.groupBy(*keys).agg(*columns)


def group_fences(metrics: DataFrame) -> DataFrame:
    """(lang, source, fences) for every group; small groups take over those of the language, small
    languages those of the corpus."""
    fine = written(sketch(metrics, ["lang", "source"]), "quality_sketches")
    by_group = fences(fine, ["lang", "source"])
    by_lang = fences(merge(fine, ["lang"]), ["lang"])
    corpus = fences(merge(fine.withColumn("all", F.lit(1)), ["all"]), ["all"])
    names = [c for c in by_group.columns if c.startswith(("lo_", "hi_"))]
    lang = by_lang.select(F.col("lang").alias("l_lang"), F.col("group_rows").alias("l_rows"),
                          *[F.col(c).alias(f"l_{c}") for c in names])
    whole = corpus.first()  # one row: the corpus
    joined = by_group.join(lang, F.col("lang").eqNullSafe(F.col("l_lang")))
    return joined.select("lang", "source", *[
        F.when(F.col("group_rows") >= MIN_GROUP, F.col(c)).when(F.col("l_rows") >= MIN_GROUP, F.col(f"l_{c}"))
        .otherwise(F.lit(whole[c] if whole else None).cast("long")).alias(c) for c in names])


def judge(metrics: DataFrame) -> DataFrame:
    """Adds ``base_failed`` and ``kept`` to a written table that has lang, source and the metrics."""
    limits = written(group_fences(metrics), "quality_fences")
    limits = limits.withColumnRenamed("lang", "f_lang").withColumnRenamed("source", "f_source")
    if limits.count() <= BROADCAST_GROUPS:
        limits = F.broadcast(limits)
    inside = F.lit(True)
    for m in METRICS:
        inside = inside & (F.col(m) <= F.col(f"hi_{m}"))
        if m in TWO_SIDED:
            inside = inside & (F.col(m) >= F.col(f"lo_{m}"))
    joined = metrics.join(limits, F.col("lang").eqNullSafe(F.col("f_lang"))
                          & F.col("source").eqNullSafe(F.col("f_source")), "left")
    return (joined.withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False))))


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                source_col: str = "source") -> DataFrame:
    """One row per document: id, the base metrics, the rule metrics, fences, base_failed, kept."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"),
                       F.col(source_col).alias("source"), F.col(text_col).alias("body"))
    metrics = written(add_rule_metrics(base_metrics(slim, "body").drop("body")), "quality_metrics")
    return judge(metrics)


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
              source_col: str = "source") -> DataFrame:
    """The documents that pass, with all their columns. Documents that pass the base rules are
    written once together with their metrics, so no text is shuffled or measured twice; the
    sketches still take in every document with a word."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"),
                       F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
                       F.col(text_col).alias("body"))
    measured = written(add_rule_metrics(base_metrics(rows, "body").drop("body"))
                       .withColumn("whole", F.when(~base_failed(), F.col("whole"))), "quality_documents")
    return judge(measured).filter("kept").select("whole.*")
