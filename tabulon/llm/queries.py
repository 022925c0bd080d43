"""Queries that apply the operators of this subpackage to their whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (dac_tokens, exact_dedup, html_extract, jaccard_join, minhash_dedup, mixing, pivot_clusters, quality_gbt,
               quality_rules, sentencepiece_scan, sharding, token_counts, whitening)
from tabulon.session import scratch_path

from .common import table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = exact_dedup.mark_copies(table(spark, sf_dir, "documents"))
    return marks.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                        F.lower(F.hex("digest")).alias("text_sha256"))


OP1_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(body) AS text_sha256
FROM t WINDOW g AS (PARTITION BY body)
"""


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_quality_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_gbt.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(F.col("id").alias("doc_id"), "held_out", "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op4_dac_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the token files of all documents and reads every document's ids back from them."""
    import public_tokenizers

    path = scratch_path(spark, "dac_tokens")
    dac_tokens.write_tokens(table(spark, sf_dir, "documents"), path,
                            public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return dac_tokens.read_documents(spark, path).withColumnRenamed("id", "doc_id")


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def _near_sql(width: int, similarity: int) -> str:
    """Shingle sets, links of all pairs and components by reachability, as a query body."""
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= {width}
         THEN list_transform(range(1, len(ws) - {width - 2}), lambda i: array_to_string(ws[i:i + {width - 1}], ' '))
         WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {similarity} * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON edges.a = reach.r)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM documents d JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id) LEFT JOIN n USING (doc_id)
"""


OP5_SQL = _near_sql(5, 80)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_rules(table(spark, sf_dir, "documents"))
    return judged.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept")


#: Metrics, sketches, fences and verdict as common table expressions over ``docs``.
QUALITY_CTES = r"""
w AS (SELECT doc_id, lang, source, coalesce(text, '') AS body,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM docs),
pos AS (SELECT doc_id, unnest(words) AS a, generate_subscripts(words, 1) AS i FROM w),
win AS (SELECT doc_id, i, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c FROM pos
        WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n
                               FROM win WHERE c IS NOT NULL) WHERE n > 1),
cov AS (SELECT doc_id, sum(least(3, coalesce(nxt - i, 3)))::BIGINT AS n_repeat_words
        FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM rep) GROUP BY doc_id),
lines AS (SELECT doc_id, list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM w),
base AS (SELECT w.doc_id, lang, source, len(words)::BIGINT AS n_words,
                length(array_to_string(words, ''))::BIGINT AS word_chars,
                length(regexp_replace(body, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
                coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
         FROM w JOIN lines USING (doc_id) LEFT JOIN cov USING (doc_id)),
met AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base),
val AS (SELECT lang, source, unnest(['symbol_share', 'dup_line_share', 'repeat_share', 'word_length']) AS metric,
               unnest([1000 * n_symbols // n_words, 1000 * n_dup_lines // n_lines, 1000 * n_repeat_words // n_words,
                       100 * word_chars // n_words]) AS v
        FROM met WHERE n_words > 0),
sk AS (SELECT lang, source, metric, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS bucket,
              count(*) AS n FROM val GROUP BY ALL),
lev AS (SELECT 0 AS lvl, lang, source, metric, bucket, n FROM sk
        UNION ALL SELECT 1, lang, NULL, metric, bucket, sum(n) FROM sk GROUP BY ALL
        UNION ALL SELECT 2, NULL, NULL, metric, bucket, sum(n) FROM sk GROUP BY ALL),
cum AS (SELECT *, sum(n) OVER (PARTITION BY lvl, lang, source, metric ORDER BY bucket) AS upto,
               sum(n) OVER (PARTITION BY lvl, lang, source, metric) AS tot FROM lev),
qs AS (SELECT lvl, lang, source, metric, max(tot) AS tot, min(bucket) FILTER (upto * 100 >= tot * 25) AS q1,
              min(bucket) FILTER (upto * 100 >= tot * 75) AS q3 FROM cum GROUP BY ALL),
fen AS (SELECT lvl, lang, source, metric, tot, q1 - 3 * spread AS lo, q3 + 3 * spread AS hi
        FROM (SELECT *, greatest(q3 - q1, CASE metric WHEN 'symbol_share' THEN 20 WHEN 'dup_line_share' THEN 120
                                          WHEN 'repeat_share' THEN 150 ELSE 60 END) AS spread FROM qs)),
lim AS (SELECT g.lang, g.source, g.metric,
               CASE WHEN g.tot >= 200 THEN g.lo WHEN l.tot >= 200 THEN l.lo ELSE c.lo END AS lo,
               CASE WHEN g.tot >= 200 THEN g.hi WHEN l.tot >= 200 THEN l.hi ELSE c.hi END AS hi
        FROM fen g JOIN fen l ON l.lvl = 1 AND l.lang IS NOT DISTINCT FROM g.lang AND l.metric = g.metric
        JOIN fen c ON c.lvl = 2 AND c.metric = g.metric WHERE g.lvl = 0),
wide AS (SELECT lang, source, max(hi) FILTER (metric = 'symbol_share') AS hs, max(hi) FILTER (metric = 'dup_line_share') AS hd,
                max(hi) FILTER (metric = 'repeat_share') AS hr, max(hi) FILTER (metric = 'word_length') AS hw,
                max(lo) FILTER (metric = 'word_length') AS lw FROM lim GROUP BY ALL),
judged AS (SELECT met.*, NOT base_failed AND coalesce(1000 * n_symbols // n_words <= hs AND 1000 * n_dup_lines // n_lines <= hd
                  AND 1000 * n_repeat_words // n_words <= hr
                  AND 100 * word_chars // n_words BETWEEN lw AND hw, false) AS kept
           FROM met LEFT JOIN wide ON wide.lang IS NOT DISTINCT FROM met.lang AND wide.source IS NOT DISTINCT FROM met.source)
"""

OP6_SQL = f"""
WITH docs AS (SELECT * FROM documents), {QUALITY_CTES}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged
"""


def sentencepiece_model() -> str:
    """Path of the public SentencePiece vocabulary that the queries use; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes every document and decodes its ids: digests of both."""
    encoded = sentencepiece_scan.encode(table(spark, sf_dir, "documents"), sentencepiece_model(), decoded=True)
    return encoded.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "n_chunks",
                          F.xxhash64("ids").alias("ids_hash"),
                          F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), sentencepiece_model())
    return counts.select(F.col("id").alias("doc_id"), "n_tokens")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_mix(table(spark, sf_dir, "documents"))
    return plan.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                       (F.col("copies") * F.col("size")).alias("taken"))


#: Sizes, targets and copies as common table expressions over ``mixin`` (doc_id, source, text).
MIX_CTES = r"""
sz AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM mixin),
src AS (SELECT source, sum(size)::BIGINT AS source_size FROM sz GROUP BY source),
wt AS (SELECT *, CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS DOUBLE) AS weight FROM src),
lvl AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(source_size * 3.0::DOUBLE) OVER (
                   ORDER BY source_size * 3.0::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                  / sum(weight) OVER (ORDER BY source_size * 3.0::DOUBLE / weight, source NULLS LAST
                                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS per_weight FROM wt),
tgt AS (SELECT source, source_size, least(source_size * 3.0::DOUBLE, max(per_weight) OVER () * weight) AS target FROM lvl),
ex AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size * 1e9::DOUBLE) ELSE 0 END::HUGEINT AS expected,
              ((('0x' || md5('9:' || coalesce('s' || source, 'null'))[1:8])::BIGINT * 1000000000) >> 32)::HUGEINT AS off FROM tgt),
num AS (SELECT sz.*, row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS LAST)::HUGEINT AS nth FROM sz),
mixed AS (SELECT doc_id, size, source_size, target,
                 ((nth * expected + off) // 1000000000 - ((nth - 1) * expected + off) // 1000000000)::BIGINT AS copies
          FROM num JOIN ex ON ex.source IS NOT DISTINCT FROM num.source)
"""

OP9_SQL = f"""
WITH mixin AS (SELECT * FROM documents), {MIX_CTES}
SELECT doc_id, size, source_size, target, copies * size AS taken FROM mixed
"""


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.shard_records(table(spark, sf_dir, "documents"), shards=24)
    return sharded.select(F.col("record.doc_id").alias("doc_id"), "size",
                          F.crc32(F.coalesce(F.col("record.text"), F.lit("")).cast("binary")).alias("text_crc32"),
                          F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op12_pivot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_clusters.cluster(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def _round(t: int) -> str:
    """Common table expressions of one round: assignment a<t> to the centroids c<t>, then c<t+1>."""
    return f"""
d{t} AS (SELECT k.vec_id, k.x, c.cluster, list_sum(list_transform(list_zip(k.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance
         FROM kept k, c{t} c),
a{t} AS (SELECT * FROM d{t} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1),
s{t} AS (SELECT cluster, i, sum(v)::HUGEINT AS s, count(*)::HUGEINT AS n
         FROM (SELECT cluster, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM a{t}) GROUP BY ALL),
m{t} AS (SELECT cluster, list((CASE WHEN s >= 0 THEN s // n ELSE -((n - 1 - s) // n) END)::BIGINT ORDER BY i) AS x FROM s{t} GROUP BY cluster),
c{t + 1} AS (SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{t} c LEFT JOIN m{t} m USING (cluster))"""


OP12_SQL = f"""
WITH kept AS (SELECT vec_id, list_transform(embedding, lambda v: floor(64 * v::DOUBLE)::BIGINT) AS x FROM embeddings
              WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda v: isfinite(v))) = 64),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster, x FROM kept QUALIFY cluster < 16),
{",".join(_round(t) for t in range(4))}
SELECT vec_id, cluster::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c3.x, ',')) AS centroid_sha256
FROM a3 JOIN c3 USING (cluster)
"""


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


OP13_SQL = f"SELECT *, doc_id = component_id AS kept FROM ({_near_sql(3, 85)})"


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_html_extract": op2_html_extract,
    "op3_quality_gbt": op3_quality_gbt,
    "op4_dac_tokens": op4_dac_tokens,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_quality_rules": op6_quality_rules,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_token_counts": op8_token_counts,
    "op9_mixing": op9_mixing,
    "op10_sharding": op10_sharding,
    "op11_whitening": op11_whitening,
    "op12_pivot_clusters": op12_pivot_clusters,
    "op13_minhash": op13_minhash,
}

ORACLE = {
    "op1_exact_dedup": OP1_SQL,
    "op5_ngram_jaccard": OP5_SQL,
    "op6_quality_rules": OP6_SQL,
    "op9_mixing": OP9_SQL,
    "op12_pivot_clusters": OP12_SQL,
    "op13_minhash": OP13_SQL,
}
