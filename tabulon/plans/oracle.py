"""DuckDB SQL for each catalog key (same bindings as ``tabulon.plans.bindings``)."""

from __future__ import annotations

from tabulon.operators.split import cut_points

ORACLE: dict[str, str] = {}

ORACLE["flagship_iqr_lang_share"] = """
WITH q AS (SELECT quantile_cont(n_chars, 0.25) AS q1, quantile_cont(n_chars, 0.75) AS q3
           FROM documents),
kept AS (SELECT d.lang FROM documents d, q
         WHERE d.n_chars >= q.q1 - 1.5 * (q.q3 - q.q1) AND d.n_chars <= q.q3 + 1.5 * (q.q3 - q.q1)),
tot AS (SELECT COUNT(*) AS n FROM kept)
SELECT *, floor(pct * CAST(100.0 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(100.0 AS DOUBLE) AS pct_2dp FROM (
SELECT lang, COUNT(*) AS n_rows,
       CAST(COUNT(*) AS DOUBLE) / (SELECT n FROM tot) AS share,
       CAST(COUNT(*) AS DOUBLE) * 100.0 / (SELECT n FROM tot) AS pct
FROM kept GROUP BY lang)
"""

# ---- bindings (same fixed values as tabulon.plans.bindings) ----
CLS3 = """(SELECT l_orderkey, l_linenumber,
  CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 END AS INTEGER) AS Target,
  l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)"""

DIRTY = """(SELECT event_id, user_id, event_type,
  CASE WHEN event_id % 7 = 0 THEN NULL
       WHEN event_id % 11 = 0 THEN CAST('NaN' AS DOUBLE)
       WHEN event_id % 13 = 0 THEN CAST('Infinity' AS DOUBLE)
       WHEN event_id % 17 = 0 THEN CAST('-Infinity' AS DOUBLE)
       ELSE value END AS value,
  CASE WHEN event_id % 19 = 0 THEN 'not a number' WHEN event_id % 23 = 0 THEN NULL
       ELSE CAST(value AS VARCHAR) END AS raw
FROM events)"""

IMPUTE = """(SELECT event_id, CAST(ts AS DATE) AS period, event_type AS grp,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id % 5 END AS code
FROM events)"""

CATS = "(SELECT event_id, CAST(user_id AS VARCHAR) AS user_key, event_type FROM events)"

BIN = """(SELECT c_custkey AS row_id, CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS label,
  (c_acctbal + CAST(1000.0 AS DOUBLE)) / CAST(11000.0 AS DOUBLE) AS score,
  CAST((c_acctbal + CAST(1000.0 AS DOUBLE)) / CAST(11000.0 AS DOUBLE) >= CAST(0.5 AS DOUBLE) AS INTEGER)
    AS prediction
FROM customer)"""

PREDS = """(SELECT v.model, v.version, CASE WHEN c.c_custkey % 2 = 0 THEN 'val' ELSE 'test' END AS dataset,
  c.c_custkey AS row_id, CAST(c.c_mktsegment = 'BUILDING' AS INTEGER) AS label,
  CAST((CASE WHEN v.bucketed THEN floor(c.s * CAST(10.0 AS DOUBLE)) / CAST(10.0 AS DOUBLE) ELSE c.s END)
       >= v.threshold AS INTEGER) AS prediction,
  CASE WHEN v.bucketed THEN floor(c.s * CAST(10.0 AS DOUBLE)) / CAST(10.0 AS DOUBLE) ELSE c.s END AS score
FROM (SELECT *, (c_acctbal + CAST(1000.0 AS DOUBLE)) / CAST(11000.0 AS DOUBLE) AS s FROM customer) c,
  (SELECT * FROM (VALUES ('m1', 1, CAST(0.4 AS DOUBLE), false), ('m2', 1, CAST(0.5 AS DOUBLE), false),
                         ('m3', 1, CAST(0.6 AS DOUBLE), false), ('m2', 2, CAST(0.3 AS DOUBLE), true))
     t(model, version, threshold, bucketed)) v)"""

MULTI = f"""(SELECT 'rule' AS model, 1 AS version, 'test' AS dataset, Target AS label,
  CAST(1 + CAST(floor(l_quantity) AS INTEGER) % 3 AS INTEGER) AS prediction FROM {CLS3})"""

BINARY_REAL = """(SELECT l.doc_id, l.quality, d.n_chars, d.lang, d.source
FROM labels l JOIN documents d USING (doc_id))"""

BY = "model, version, dataset"
FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SKEW = ["value", "user_id"]


def r9(expr: str) -> str:
    return f"round({expr}, 9)"


# ---- shared CTE bodies ----
def _binary_metric_ctes(src: str = PREDS) -> str:
    return f"""p AS (SELECT * FROM {src}),
bc AS (SELECT {BY},
  CAST(COUNT(*) FILTER (WHERE label = 1 AND prediction = 1) AS BIGINT) AS tp,
  CAST(COUNT(*) FILTER (WHERE label = 0 AND prediction = 0) AS BIGINT) AS tn,
  CAST(COUNT(*) FILTER (WHERE label = 0 AND prediction = 1) AS BIGINT) AS fp,
  CAST(COUNT(*) FILTER (WHERE label = 1 AND prediction = 0) AS BIGINT) AS fn
  FROM p GROUP BY {BY}),
bm0 AS (SELECT {BY},
  CASE WHEN tp + tn + fp + fn = 0 THEN NULL ELSE CAST(tp + tn AS DOUBLE) / CAST(tp + tn + fp + fn AS DOUBLE) END AS accuracy,
  CASE WHEN tp + fp = 0 THEN NULL ELSE CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) END AS precision,
  CASE WHEN tp + fn = 0 THEN NULL ELSE CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) END AS recall
  FROM bc),
bm AS (SELECT *, CASE WHEN precision + recall = 0 THEN NULL
                      ELSE CAST(2.0 AS DOUBLE) * (precision * recall) / (precision + recall) END AS f1_score
  FROM bm0)"""


def _curve_ctes(src: str = PREDS, with_source: bool = True) -> str:
    head = f"p AS (SELECT * FROM {src}),\n" if with_source else ""
    return head + f"""g AS (SELECT {BY}, score,
  CAST(COUNT(*) FILTER (WHERE label = 1) AS BIGINT) AS tp,
  CAST(COUNT(*) FILTER (WHERE label <> 1) AS BIGINT) AS fp
  FROM p WHERE score IS NOT NULL AND label IS NOT NULL GROUP BY {BY}, score),
gc AS (SELECT *,
  CAST(SUM(tp) OVER (PARTITION BY {BY} ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS tp_cum,
  CAST(SUM(fp) OVER (PARTITION BY {BY} ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS fp_cum,
  CAST(SUM(tp) OVER (PARTITION BY {BY}) AS BIGINT) AS P,
  CAST(SUM(fp) OVER (PARTITION BY {BY}) AS BIGINT) AS N
  FROM g),
auc AS (SELECT {BY},
  CASE WHEN 2.0 * CAST(max(P) AS DOUBLE) * CAST(max(N) AS DOUBLE) = 0 THEN NULL ELSE
  SUM(CAST(fp AS DOUBLE) * (CAST(2.0 AS DOUBLE) * CAST(tp_cum - tp AS DOUBLE) + CAST(tp AS DOUBLE)))
    / (CAST(2.0 AS DOUBLE) * CAST(max(P) AS DOUBLE) * CAST(max(N) AS DOUBLE)) END AS roc_auc,
  SUM(CASE WHEN P > 0 THEN (CAST(tp AS DOUBLE) / CAST(P AS DOUBLE))
      * ((CASE WHEN tp_cum + fp_cum = 0 THEN NULL ELSE CAST(tp_cum AS DOUBLE) / CAST(tp_cum + fp_cum AS DOUBLE) END)
         + (CASE WHEN (tp_cum - tp) + (fp_cum - fp) = 0 THEN CAST(1.0 AS DOUBLE)
                 ELSE CAST(tp_cum - tp AS DOUBLE) / CAST((tp_cum - tp) + (fp_cum - fp) AS DOUBLE) END))
      / CAST(2.0 AS DOUBLE) END) AS pr_auc
  FROM gc GROUP BY {BY})"""


def _eval_long(recursive: bool = False) -> str:
    return f"""WITH {"RECURSIVE " if recursive else ""}{_binary_metric_ctes()}, {_curve_ctes(with_source=False)},
ev AS (
  SELECT {BY}, 'accuracy' AS metric, accuracy AS value FROM bm
  UNION ALL SELECT {BY}, 'precision', precision FROM bm
  UNION ALL SELECT {BY}, 'recall', recall FROM bm
  UNION ALL SELECT {BY}, 'f1_score', f1_score FROM bm
  UNION ALL SELECT {BY}, 'roc_auc', roc_auc FROM auc
  UNION ALL SELECT {BY}, 'pr_auc', pr_auc FROM auc)"""


def _class_ctes(src: str = MULTI, by: str = BY) -> str:
    return f"""m AS (SELECT * FROM {src}),
cells AS (SELECT {by}, label, prediction, CAST(COUNT(*) AS BIGINT) AS n FROM m GROUP BY {by}, label, prediction),
roles AS (SELECT {by}, label AS class, n AS a, CAST(0 AS BIGINT) AS p,
                 CASE WHEN label = prediction THEN n ELSE CAST(0 AS BIGINT) END AS t FROM cells
          UNION ALL SELECT {by}, prediction, CAST(0 AS BIGINT), n, CAST(0 AS BIGINT) FROM cells),
ct AS (SELECT {by}, class, CAST(SUM(a) AS BIGINT) AS support, CAST(SUM(p) AS BIGINT) AS predicted,
              CAST(SUM(t) AS BIGINT) AS tp FROM roles GROUP BY {by}, class),
cs0 AS (SELECT *, CASE WHEN predicted = 0 THEN CAST(0.0 AS DOUBLE) ELSE CAST(tp AS DOUBLE) / CAST(predicted AS DOUBLE) END AS precision,
                  CASE WHEN support = 0 THEN CAST(0.0 AS DOUBLE) ELSE CAST(tp AS DOUBLE) / CAST(support AS DOUBLE) END AS recall
        FROM ct),
cs AS (SELECT *, CASE WHEN precision + recall = 0 THEN CAST(0.0 AS DOUBLE)
                      ELSE CAST(2.0 AS DOUBLE) * (precision * recall) / (precision + recall) END AS f1_score FROM cs0)"""


def _quartile_fences(src: str, cols: list[str], alias: str = "f") -> str:
    parts = []
    for c in cols:
        parts.append(f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3")
    return f"{alias} AS (SELECT {', '.join(parts)} FROM {src})"


def _outside(c: str, alias: str = "f", expr: str | None = None) -> str:
    x = expr or c
    lo = f"{alias}.{c}_q1 - CAST(1.5 AS DOUBLE) * ({alias}.{c}_q3 - {alias}.{c}_q1)"
    hi = f"{alias}.{c}_q3 + CAST(1.5 AS DOUBLE) * ({alias}.{c}_q3 - {alias}.{c}_q1)"
    return f"COALESCE({x} < {lo} OR {x} > {hi}, false)"


# ---------------------------------------------------------------- IO
ORACLE["io_csv_roundtrip"] = "SELECT n_nationkey, n_name, n_regionkey FROM nation"
ORACLE["io_parquet_project"] = "SELECT l_orderkey, l_quantity FROM lineitem"
ORACLE["io_parquet_roundtrip"] = f"SELECT * FROM {CLS3}"
ORACLE["metrics_long"] = _eval_long() + f"\nSELECT {BY}, metric, {r9('value')} AS value FROM ev"
ORACLE["metrics_wide"] = _eval_long() + f"""
SELECT {BY},
  {r9("max(value) FILTER (WHERE metric = 'accuracy')")} AS accuracy,
  {r9("max(value) FILTER (WHERE metric = 'precision')")} AS precision,
  {r9("max(value) FILTER (WHERE metric = 'recall')")} AS recall,
  {r9("max(value) FILTER (WHERE metric = 'f1_score')")} AS f1_score,
  {r9("max(value) FILTER (WHERE metric = 'roc_auc')")} AS roc_auc,
  {r9("max(value) FILTER (WHERE metric = 'pr_auc')")} AS pr_auc
FROM ev GROUP BY {BY}"""
ORACLE["latest_version"] = f"""WITH p AS (SELECT * FROM {PREDS}),
l AS (SELECT model, max(version) AS version FROM p GROUP BY model)
SELECT p.* FROM p JOIN l USING (model, version)"""
ORACLE["model_versions"] = f"""SELECT model, version, CAST(COUNT(*) AS BIGINT) AS n_rows
FROM {PREDS} GROUP BY model, version"""

# ---------------------------------------------------------------- CL
ORACLE["cast_columns"] = f"""SELECT event_id, TRY_CAST(raw AS DOUBLE) AS raw,
  TRY_CAST(user_id AS INTEGER) AS user_id FROM {DIRTY}"""
ORACLE["project_columns"] = f"SELECT Target, l_quantity FROM {CLS3}"
ORACLE["drop_columns"] = f"SELECT l_orderkey, l_linenumber, Target, l_quantity, l_extendedprice FROM {CLS3}"
ORACLE["rename_columns"] = f"SELECT Target AS label, l_quantity AS quantity FROM {CLS3}"
ORACLE["table_shape"] = f"SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(7 AS BIGINT) AS n_columns FROM {CLS3}"
ORACLE["tail_rows"] = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 10"
ORACLE["head_rows"] = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10"
ORACLE["distinct_labels"] = f"SELECT DISTINCT Target FROM {CLS3}"
ORACLE["missing_rows"] = f"""SELECT event_id, (value IS NULL OR isnan(value)) AS value_missing,
  raw IS NULL AS raw_missing FROM {DIRTY}
WHERE (value IS NULL OR isnan(value)) OR raw IS NULL"""
ORACLE["fill_missing"] = f"""SELECT event_id, CASE WHEN value IS NULL OR isnan(value) THEN 0 ELSE value END AS value
FROM {DIRTY}"""
ORACLE["filter_equals"] = """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R'"""
_EV_FLAGS = f"""WITH {_quartile_fences('events', SKEW)},
fl AS (SELECT e.event_id, CAST({_outside('value', expr='e.value')} AS INTEGER) AS value_is_outlier,
  CAST({_outside('user_id', expr='e.user_id')} AS INTEGER) AS user_id_is_outlier
  FROM events e, f)"""
ORACLE["flag_outliers"] = _EV_FLAGS + "\nSELECT * FROM fl"
ORACLE["rows_any_outlier"] = _EV_FLAGS + "\nSELECT event_id FROM fl WHERE value_is_outlier = 1 OR user_id_is_outlier = 1"
ORACLE["rows_no_outlier"] = _EV_FLAGS + "\nSELECT event_id FROM fl WHERE value_is_outlier = 0 AND user_id_is_outlier = 0"
ORACLE["remove_outliers"] = ORACLE["rows_no_outlier"]
ORACLE["case_label"] = f"""SELECT row_id, CASE WHEN prediction = 1 THEN 'Buy' ELSE 'Do not buy' END AS decision
FROM {BIN}"""

# ---------------------------------------------------------------- JN
ORACLE["join_frequency_left"] = f"""WITH c AS (SELECT * FROM {CATS}),
fq AS (SELECT user_key, CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM c) AS user_key_frequency
       FROM c GROUP BY user_key)
SELECT c.event_id, c.user_key, fq.user_key_frequency FROM c LEFT JOIN fq
  ON c.user_key IS NOT DISTINCT FROM fq.user_key"""
ORACLE["join_class_counts"] = f"""WITH c AS (SELECT * FROM {CLS3}),
k AS (SELECT Target, CAST(COUNT(*) AS BIGINT) AS n_class FROM c GROUP BY Target)
SELECT c.Target, c.l_quantity, k.n_class FROM c JOIN k USING (Target)"""

# ---------------------------------------------------------------- PF
ORACLE["infinite_counts"] = f"""SELECT * FROM (
  SELECT 'value' AS "column", CAST(COUNT(*) FILTER (WHERE isinf(value)) AS BIGINT) AS n_infinite
  FROM {DIRTY}) WHERE n_infinite > 0"""
ORACLE["missing_columns"] = f"""WITH d AS (SELECT * FROM {DIRTY}),
u AS (
  SELECT 'event_id' AS "column", CAST(COUNT(*) FILTER (WHERE event_id IS NULL) AS BIGINT) AS n_missing, 'numeric' AS kind FROM d
  UNION ALL SELECT 'user_id', CAST(COUNT(*) FILTER (WHERE user_id IS NULL) AS BIGINT), 'numeric' FROM d
  UNION ALL SELECT 'event_type', CAST(COUNT(*) FILTER (WHERE event_type IS NULL) AS BIGINT), 'categorical' FROM d
  UNION ALL SELECT 'value', CAST(COUNT(*) FILTER (WHERE value IS NULL OR isnan(value)) AS BIGINT), 'numeric' FROM d
  UNION ALL SELECT 'raw', CAST(COUNT(*) FILTER (WHERE raw IS NULL) AS BIGINT), 'categorical' FROM d)
SELECT * FROM u WHERE n_missing > 0"""
ORACLE["null_counts"] = f"""WITH d AS (SELECT * FROM {DIRTY})
SELECT 'event_id' AS "column", CAST(COUNT(*) FILTER (WHERE event_id IS NULL) AS BIGINT) AS n_null FROM d
UNION ALL SELECT 'user_id', CAST(COUNT(*) FILTER (WHERE user_id IS NULL) AS BIGINT) FROM d
UNION ALL SELECT 'event_type', CAST(COUNT(*) FILTER (WHERE event_type IS NULL) AS BIGINT) FROM d
UNION ALL SELECT 'value', CAST(COUNT(*) FILTER (WHERE value IS NULL) AS BIGINT) FROM d
UNION ALL SELECT 'raw', CAST(COUNT(*) FILTER (WHERE raw IS NULL) AS BIGINT) FROM d"""
ORACLE["class_counts"] = f"SELECT Target, CAST(COUNT(*) AS BIGINT) AS n_rows FROM {CLS3} GROUP BY Target"
ORACLE["class_distribution"] = f"""WITH c AS (SELECT * FROM {CLS3}), t AS (SELECT COUNT(*) AS n FROM c)
SELECT *, floor(pct * CAST(100.0 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(100.0 AS DOUBLE) AS pct_2dp FROM (
SELECT Target, CAST(COUNT(*) AS BIGINT) AS n_rows,
  CAST(COUNT(*) AS DOUBLE) / CAST((SELECT n FROM t) AS DOUBLE) AS share,
  CAST(COUNT(*) AS DOUBLE) * CAST(100.0 AS DOUBLE) / CAST((SELECT n FROM t) AS DOUBLE) AS pct
FROM c GROUP BY Target)"""


def _quantile_union(src: str, cols: list[str], probs: list[float], fn: str, rnd: bool) -> str:
    parts = []
    for c in cols:
        for p in probs:
            v = f"CAST({fn}({c}, {p}) AS DOUBLE)"
            parts.append(f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS prob, "
                         f"{r9(v) if rnd else v} AS value FROM {src}")
    return "\nUNION ALL ".join(parts)


ORACLE["quantiles_exact"] = _quantile_union(CLS3, FEATS, [0.25, 0.5, 0.75], "quantile_cont", True)
ORACLE["quantiles_disc"] = _quantile_union(CLS3, FEATS, [0.1, 0.25, 0.5, 0.75, 0.9], "quantile_disc", False)
ORACLE["quantiles_skew"] = _quantile_union("documents", ["n_chars"], [0.01, 0.25, 0.5, 0.75, 0.99],
                                           "quantile_cont", True)


def _box(c: str) -> str:
    lo = f"(q1 - CAST(1.5 AS DOUBLE) * (q3 - q1))"
    hi = f"(q3 + CAST(1.5 AS DOUBLE) * (q3 - q1))"
    return f"""SELECT '{c}' AS "column", {r9('q1')} AS q1, {r9('med')} AS median, {r9('q3')} AS q3,
  CAST(min({c}) FILTER (WHERE {c} >= {lo} AND {c} <= {hi}) AS DOUBLE) AS whisker_lo,
  CAST(max({c}) FILTER (WHERE {c} >= {lo} AND {c} <= {hi}) AS DOUBLE) AS whisker_hi,
  CAST(COUNT(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) AS BIGINT) AS n_fliers
FROM events, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS med,
                     quantile_cont({c}, 0.75) AS q3 FROM events) q
GROUP BY q1, med, q3"""


ORACLE["box_stats"] = "\nUNION ALL ".join(_box(c) for c in SKEW)
ORACLE["outlier_counts"] = f"""WITH {_quartile_fences('events', SKEW)}
SELECT 'value' AS "column", CAST(COUNT(*) FILTER (WHERE {_outside('value')}) AS BIGINT) AS n_outliers FROM events, f
UNION ALL
SELECT 'user_id', CAST(COUNT(*) FILTER (WHERE {_outside('user_id')}) AS BIGINT) FROM events, f"""
ORACLE["outlier_recheck"] = f"""WITH {_quartile_fences('events', SKEW)},
k AS (SELECT e.value, e.user_id FROM events e, f WHERE NOT ({_outside('value', expr='e.value')})
      AND NOT ({_outside('user_id', expr='e.user_id')})),
{_quartile_fences('k', SKEW, 'f2')}
SELECT 'value' AS "column", CAST(COUNT(*) FILTER (WHERE {_outside('value', 'f2')}) AS BIGINT) AS n_outliers FROM k, f2
UNION ALL
SELECT 'user_id', CAST(COUNT(*) FILTER (WHERE {_outside('user_id', 'f2')}) AS BIGINT) FROM k, f2"""
ORACLE["histogram_by_class"] = f"""WITH c AS (SELECT * FROM {CLS3}),
mm AS (SELECT CAST(min(l_extendedprice) AS DOUBLE) AS lo, CAST(max(l_extendedprice) AS DOUBLE) AS hi FROM c),
b AS (SELECT Target, CAST(least(floor((l_extendedprice - lo) / (hi - lo) * CAST(50.0 AS DOUBLE)), 49) AS INTEGER) AS bin,
             lo, hi FROM c, mm WHERE l_extendedprice IS NOT NULL)
SELECT Target, bin, CAST(COUNT(*) AS BIGINT) AS n_rows,
  {r9('max(lo) + max(hi - lo) * CAST(bin AS DOUBLE) / CAST(50.0 AS DOUBLE)')} AS bin_lo
FROM b GROUP BY Target, bin"""


def _corr_sql(a: str, b: str) -> str:
    return (f"CASE WHEN stddev_pop({a}) = 0 OR stddev_pop({b}) = 0 THEN NULL "
            f"ELSE covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})) END")


_CORR_COLS = ["Target", *FEATS]
ORACLE["correlation_matrix"] = "\nUNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {r9(_corr_sql(a, b))} AS corr FROM {CLS3}"
    for a in _CORR_COLS for b in _CORR_COLS)
ORACLE["target_correlation"] = "SELECT * FROM (" + "\nUNION ALL ".join(
    f"SELECT '{a}' AS \"column\", {r9(_corr_sql(a, 'Target'))} AS corr FROM {CLS3}"
    for a in FEATS) + ") WHERE corr IS NOT NULL AND NOT isnan(corr)"
ORACLE["high_cardinality"] = f"""WITH c AS (SELECT * FROM {CATS}),
u AS (SELECT 'user_key' AS "column", CAST(COUNT(DISTINCT user_key) + max(CAST(user_key IS NULL AS INTEGER)) AS BIGINT) AS n_groups FROM c
      UNION ALL
      SELECT 'event_type', CAST(COUNT(DISTINCT event_type) + max(CAST(event_type IS NULL AS INTEGER)) AS BIGINT) FROM c)
SELECT *, n_groups > 100 AS is_high FROM u"""
ORACLE["frequency_table"] = f"""WITH c AS (SELECT * FROM {CATS})
SELECT event_type, CAST(COUNT(*) AS BIGINT) AS n_rows,
  CAST(COUNT(*) AS DOUBLE) / CAST((SELECT COUNT(*) FROM c) AS DOUBLE) AS frequency
FROM c GROUP BY event_type"""
ORACLE["min_positive_score"] = f"""SELECT {BY}, min(score) FILTER (WHERE prediction = 1) AS min_positive_score
FROM {PREDS} GROUP BY {BY}"""

# ---------------------------------------------------------------- OW
ORACLE["impute_group_max"] = f"""WITH d AS (SELECT * FROM {IMPUTE})
SELECT event_id, COALESCE(value, max(value) OVER (PARTITION BY period, grp)) AS value FROM d"""
ORACLE["impute_group_mode"] = f"""WITH d AS (SELECT * FROM {IMPUTE}),
cnt AS (SELECT period, grp, code, COUNT(*) AS n FROM d WHERE code IS NOT NULL GROUP BY period, grp, code),
md AS (SELECT period, grp, code AS mode_code FROM (
  SELECT *, row_number() OVER (PARTITION BY period, grp ORDER BY n DESC, code) AS rn FROM cnt) WHERE rn = 1)
SELECT d.event_id, COALESCE(d.code, md.mode_code) AS code
FROM d LEFT JOIN md ON d.period IS NOT DISTINCT FROM md.period AND d.grp IS NOT DISTINCT FROM md.grp"""
ORACLE["forward_fill"] = f"""SELECT event_id, last_value(value IGNORE NULLS) OVER (PARTITION BY grp ORDER BY event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM {IMPUTE}"""
ORACLE["forward_fill_global"] = f"""SELECT event_id, last_value(value IGNORE NULLS) OVER (ORDER BY event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM {IMPUTE}"""

# ---------------------------------------------------------------- FE
ORACLE["label_encode"] = """WITH cu AS (SELECT c_custkey, c_mktsegment, c_name FROM customer),
s AS (SELECT c_mktsegment AS v, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS code
      FROM (SELECT DISTINCT c_mktsegment FROM cu WHERE c_mktsegment IS NOT NULL)),
n AS (SELECT c_name AS v, dense_rank() OVER (ORDER BY c_name) - 1 AS code
      FROM (SELECT DISTINCT c_name FROM cu WHERE c_name IS NOT NULL))
SELECT cu.c_custkey,
  CAST(COALESCE(s.code, (SELECT COUNT(*) FROM s)) AS INTEGER) AS c_mktsegment,
  CAST(COALESCE(n.code, (SELECT COUNT(*) FROM n)) AS INTEGER) AS c_name
FROM cu LEFT JOIN s ON cu.c_mktsegment = s.v LEFT JOIN n ON cu.c_name = n.v"""
ORACLE["string_index"] = f"""WITH c AS (SELECT * FROM {CATS}),
et AS (SELECT event_type AS v, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, event_type) - 1 AS DOUBLE) AS idx
       FROM c WHERE event_type IS NOT NULL GROUP BY event_type),
uk AS (SELECT user_key AS v, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, user_key) - 1 AS DOUBLE) AS idx
       FROM c WHERE user_key IS NOT NULL GROUP BY user_key)
SELECT c.event_id, et.idx AS event_type_index, uk.idx AS user_key_index
FROM c JOIN et ON c.event_type = et.v JOIN uk ON c.user_key = uk.v"""
ORACLE["frequency_encode"] = f"""WITH c AS (SELECT * FROM {CATS}),
fq AS (SELECT user_key, CAST(COUNT(*) AS DOUBLE) / CAST((SELECT COUNT(*) FROM c) AS DOUBLE) AS user_key_encoded
       FROM c GROUP BY user_key)
SELECT c.event_id, c.event_type, fq.user_key_encoded FROM c LEFT JOIN fq
  ON c.user_key IS NOT DISTINCT FROM fq.user_key"""
_Z = ", ".join(f"{r9(f'CASE WHEN s.{c}_s = 0 THEN 0.0 ELSE (CAST(c.{c} AS DOUBLE) - s.{c}_m) / s.{c}_s END')} AS {c}"
               for c in FEATS)
ORACLE["standard_scale"] = f"""WITH c AS (SELECT * FROM {CLS3}),
s AS (SELECT {', '.join(f'avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s' for c in FEATS)} FROM c)
SELECT c.Target, {_Z} FROM c, s"""
_MM = ", ".join(f"CASE WHEN s.{c}_hi = s.{c}_lo THEN CAST(0.5 AS DOUBLE) "
                f"ELSE (CAST(c.{c} AS DOUBLE) - s.{c}_lo) / (s.{c}_hi - s.{c}_lo) END AS {c}" for c in FEATS)
ORACLE["minmax_scale"] = f"""WITH c AS (SELECT * FROM {CLS3}),
s AS (SELECT {', '.join(f'CAST(min({c}) AS DOUBLE) AS {c}_lo, CAST(max({c}) AS DOUBLE) AS {c}_hi' for c in FEATS)} FROM c)
SELECT c.Target, {_MM} FROM c, s"""
ORACLE["assemble_vector"] = f"""SELECT Target, {', '.join(f'CAST({c} AS DOUBLE) AS f{i}' for i, c in enumerate(FEATS))}
FROM {CLS3}"""


def _feature_chain_sql(with_id: bool) -> str:
    keep = "br.doc_id, br.quality" if with_id else "br.quality"
    return f"""WITH br AS (SELECT * FROM {BINARY_REAL}),
li AS (SELECT lang, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, lang) - 1 AS DOUBLE) AS idx
       FROM br WHERE lang IS NOT NULL GROUP BY lang),
se AS (SELECT source, CAST(COUNT(*) AS DOUBLE) / CAST((SELECT COUNT(*) FROM br) AS DOUBLE) AS enc
       FROM br GROUP BY source),
mm AS (SELECT CAST(min(n_chars) AS DOUBLE) AS nlo, CAST(max(n_chars) AS DOUBLE) AS nhi FROM br)
SELECT {keep}, li.idx AS f0,
  CASE WHEN mm.nhi = mm.nlo THEN CAST(0.5 AS DOUBLE) ELSE (CAST(br.n_chars AS DOUBLE) - mm.nlo) / (mm.nhi - mm.nlo) END AS f1,
  se.enc AS f2
FROM br JOIN li USING (lang) LEFT JOIN se ON br.source IS NOT DISTINCT FROM se.source, mm"""


ORACLE["feature_chain"] = _feature_chain_sql(False)
ORACLE["feature_chain_with_id"] = _feature_chain_sql(True)
ORACLE["preprocess_chain"] = f"""WITH d AS (SELECT event_id, value, TRY_CAST(raw AS DOUBLE) AS raw FROM {DIRTY}),
fl AS (SELECT event_id, CASE WHEN value IS NULL OR isnan(value) THEN 0 ELSE value END AS value,
              CASE WHEN raw IS NULL OR isnan(raw) THEN 0 ELSE raw END AS raw FROM d),
{_quartile_fences('fl', ['value', 'raw'])},
k AS (SELECT fl.* FROM fl, f WHERE NOT ({_outside('value', expr='fl.value')}) AND NOT ({_outside('raw', expr='fl.raw')})),
s AS (SELECT avg(value) AS vm, stddev_pop(value) AS vs, avg(raw) AS rm, stddev_pop(raw) AS rs FROM k)
SELECT event_id, {r9('CASE WHEN vs = 0 THEN 0.0 ELSE (value - vm) / vs END')} AS f0,
  {r9('CASE WHEN rs = 0 THEN 0.0 ELSE (raw - rm) / rs END')} AS f1 FROM k, s"""

# ---------------------------------------------------------------- SP
def _part(key: str, weights: list[float], names: tuple[str, ...]) -> str:
    """The part whose stretch of the 60-bit hash range holds the key's hash."""
    h = f"CAST(concat('0x', substr(md5(CAST({key} AS VARCHAR)), 1, 15)) AS BIGINT)"
    cases = " ".join(f"WHEN {h} < {end} THEN '{name}'" for name, end in zip(names, cut_points(weights)))
    return f"CASE {cases} ELSE '{names[-1]}' END"


ORACLE["feature_chain_new_rows"] = f"""WITH br AS (SELECT *, {_part('doc_id', [0.5, 0.5], ('train', 'batch'))} AS part FROM {BINARY_REAL}),
tr AS (SELECT * FROM br WHERE part = 'train'),
li AS (SELECT lang, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, lang) - 1 AS DOUBLE) AS idx
       FROM tr WHERE lang IS NOT NULL GROUP BY lang),
se AS (SELECT source, CAST(COUNT(*) AS DOUBLE) / CAST((SELECT COUNT(*) FROM tr) AS DOUBLE) AS enc FROM tr GROUP BY source),
mm AS (SELECT CAST(min(n_chars) AS DOUBLE) AS nlo, CAST(max(n_chars) AS DOUBLE) AS nhi FROM tr)
SELECT br.doc_id, br.quality, li.idx AS f0, (CAST(br.n_chars AS DOUBLE) - mm.nlo) / (mm.nhi - mm.nlo) AS f1, coalesce(se.enc, 0) AS f2
FROM br JOIN li USING (lang) LEFT JOIN se ON br.source IS NOT DISTINCT FROM se.source, mm WHERE part = 'batch'"""
ORACLE["frequency_encode_new_rows"] = f"""WITH c AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS segment,
    {_part('c_custkey', [0.8, 0.2], ('train', 'batch'))} AS part FROM customer),
tr AS (SELECT *, COUNT(*) OVER () AS n FROM c WHERE part = 'train'),
nf AS (SELECT c_name, CAST(COUNT(*) AS DOUBLE) / CAST(max(n) AS DOUBLE) AS f FROM tr GROUP BY c_name),
sf AS (SELECT segment, CAST(COUNT(*) AS DOUBLE) / CAST(max(n) AS DOUBLE) AS f FROM tr GROUP BY segment)
SELECT c_custkey, CAST(coalesce(nf.f, 0) AS DOUBLE) AS c_name_encoded, CAST(coalesce(sf.f, 0) AS DOUBLE) AS segment_encoded
FROM c LEFT JOIN nf USING (c_name) LEFT JOIN sf ON sf.segment IS NOT DISTINCT FROM c.segment WHERE part = 'batch'"""
ORACLE["preprocess_new_rows"] = f"""WITH d AS (SELECT event_id, value, TRY_CAST(raw AS DOUBLE) AS raw,
    {_part('event_id', [0.7, 0.3], ('train', 'batch'))} AS part FROM {DIRTY}),
al AS (SELECT event_id, part, CASE WHEN value IS NULL OR isnan(value) THEN 0 ELSE value END AS value,
              CASE WHEN raw IS NULL OR isnan(raw) THEN 0 ELSE raw END AS raw FROM d),
fl AS (SELECT * FROM al WHERE part = 'train'),
{_quartile_fences('fl', ['value', 'raw'])},
k AS (SELECT al.* FROM al, f WHERE NOT ({_outside('value', expr='al.value')}) AND NOT ({_outside('raw', expr='al.raw')})),
s AS (SELECT avg(value) AS vm, stddev_pop(value) AS vs, avg(raw) AS rm, stddev_pop(raw) AS rs FROM k WHERE part = 'train')
SELECT event_id, {r9('CASE WHEN vs = 0 THEN 0.0 ELSE (value - vm) / vs END')} AS f0,
  {r9('CASE WHEN rs = 0 THEN 0.0 ELSE (raw - rm) / rs END')} AS f1 FROM k, s WHERE part = 'batch'"""
THREE = ("train", "test", "val")
ORACLE["hash_split"] = f"""SELECT c_custkey, {_part('c_custkey', [0.8, 0.1, 0.1], THREE)} AS split FROM customer"""
ORACLE["hash_split_small_parts"] = f"""SELECT l_orderkey, l_linenumber,
  {_part('l_orderkey', [0.99, 0.005, 0.005], THREE)} AS split FROM lineitem"""
ORACLE["random_split"] = "SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_in_two_parts FROM events"
ORACLE["class_weights"] = f"""WITH c AS (SELECT * FROM {CLS3}),
k AS (SELECT Target, COUNT(*) AS n FROM c GROUP BY Target),
w AS (SELECT Target, CAST(SUM(n) OVER () AS DOUBLE) / (CAST(COUNT(*) OVER () AS DOUBLE) * CAST(n AS DOUBLE)) AS weight FROM k)
SELECT c.Target, c.l_quantity, w.weight FROM c JOIN w USING (Target)"""

# ---------------------------------------------------------------- ML (champion rule only)
ORACLE["pick_champion"] = _eval_long(recursive=True) + f""",
wt AS (SELECT model, version,
         max(value) FILTER (WHERE metric = 'accuracy') AS accuracy,
         max(value) FILTER (WHERE metric = 'f1_score') AS f1_score,
         max(value) FILTER (WHERE metric = 'roc_auc') AS roc_auc
       FROM ev WHERE dataset = 'test' GROUP BY model, version),
ordered AS (SELECT row_number() OVER (ORDER BY model, version) AS pos, * FROM wt),
fold AS (SELECT pos, model, version, accuracy, f1_score, roc_auc FROM ordered WHERE pos = 1
  UNION ALL
  SELECT o.pos,
    CASE WHEN o.accuracy > f.accuracy AND o.f1_score > f.f1_score AND o.roc_auc > f.roc_auc THEN o.model ELSE f.model END,
    CASE WHEN o.accuracy > f.accuracy AND o.f1_score > f.f1_score AND o.roc_auc > f.roc_auc THEN o.version ELSE f.version END,
    CASE WHEN o.accuracy > f.accuracy AND o.f1_score > f.f1_score AND o.roc_auc > f.roc_auc THEN o.accuracy ELSE f.accuracy END,
    CASE WHEN o.accuracy > f.accuracy AND o.f1_score > f.f1_score AND o.roc_auc > f.roc_auc THEN o.f1_score ELSE f.f1_score END,
    CASE WHEN o.accuracy > f.accuracy AND o.f1_score > f.f1_score AND o.roc_auc > f.roc_auc THEN o.roc_auc ELSE f.roc_auc END
  FROM fold f JOIN ordered o ON o.pos = f.pos + 1)
SELECT model, version, {r9('accuracy')} AS accuracy, {r9('f1_score')} AS f1_score, {r9('roc_auc')} AS roc_auc
FROM fold ORDER BY pos DESC LIMIT 1"""

# ---------------------------------------------------------------- EV
ORACLE["binary_counts"] = f"WITH {_binary_metric_ctes()}\nSELECT * FROM bc"
ORACLE["binary_metrics"] = f"WITH {_binary_metric_ctes()}\nSELECT {BY}, accuracy, precision, recall, f1_score FROM bm"
ORACLE["binary_metrics_nan"] = f"""WITH p AS (SELECT * FROM {PREDS}),
a AS (SELECT {BY}, COUNT(*) FILTER (WHERE label = prediction) AS eq, COUNT(*) AS n,
        COUNT(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
        COUNT(*) FILTER (WHERE prediction = 1) AS pp, COUNT(*) FILTER (WHERE label = 1) AS ap
      FROM p GROUP BY {BY}),
b AS (SELECT {BY}, CASE WHEN n = 0 THEN CAST('NaN' AS DOUBLE) ELSE CAST(eq AS DOUBLE) / CAST(n AS DOUBLE) END AS accuracy,
        CASE WHEN pp = 0 THEN CAST('NaN' AS DOUBLE) ELSE CAST(tp AS DOUBLE) / CAST(pp AS DOUBLE) END AS precision,
        CASE WHEN ap = 0 THEN CAST('NaN' AS DOUBLE) ELSE CAST(tp AS DOUBLE) / CAST(ap AS DOUBLE) END AS recall FROM a)
SELECT *, CASE WHEN precision + recall = 0 THEN CAST('NaN' AS DOUBLE)
               ELSE CAST(2.0 AS DOUBLE) * (precision * recall) / (precision + recall) END AS f1_score FROM b"""
ORACLE["confusion_matrix"] = f"""WITH m AS (SELECT * FROM {MULTI}),
cells AS (SELECT {BY}, label, prediction, CAST(COUNT(*) AS BIGINT) AS n FROM m GROUP BY {BY}, label, prediction),
cls AS (SELECT DISTINCT {BY}, label AS c FROM cells UNION SELECT DISTINCT {BY}, prediction FROM cells),
grid AS (SELECT a.model, a.version, a.dataset, a.c AS label, b.c AS prediction FROM cls a JOIN cls b
         ON a.model = b.model AND a.version = b.version AND a.dataset = b.dataset)
SELECT grid.*, COALESCE(cells.n, 0) AS n FROM grid LEFT JOIN cells USING ({BY}, label, prediction)"""
ORACLE["confusion_wide"] = f"""WITH m AS (SELECT * FROM {MULTI})
SELECT {BY}, label,
  CAST(COUNT(*) FILTER (WHERE prediction = 1) AS BIGINT) AS pred_1,
  CAST(COUNT(*) FILTER (WHERE prediction = 2) AS BIGINT) AS pred_2,
  CAST(COUNT(*) FILTER (WHERE prediction = 3) AS BIGINT) AS pred_3
FROM m GROUP BY {BY}, label"""
ORACLE["per_class_metrics"] = f"""WITH {_class_ctes()}
SELECT {BY}, class, precision, recall, f1_score, support FROM cs WHERE support > 0"""
ORACLE["classification_report"] = f"""WITH {_class_ctes()},
g AS (SELECT {BY}, SUM(tp) AS tp, SUM(support) AS n, avg(precision) AS mp, avg(recall) AS mr, avg(f1_score) AS mf,
        SUM(precision * support) AS wp, SUM(recall * support) AS wr, SUM(f1_score * support) AS wf
      FROM cs GROUP BY {BY})
SELECT {BY}, CAST(class AS VARCHAR) AS class_label, {r9('precision')} AS precision, {r9('recall')} AS recall,
       {r9('f1_score')} AS f1_score, support FROM cs
UNION ALL SELECT {BY}, 'accuracy', NULL, NULL, {r9('CAST(tp AS DOUBLE) / CAST(n AS DOUBLE)')}, CAST(n AS BIGINT) FROM g
UNION ALL SELECT {BY}, 'macro avg', {r9('mp')}, {r9('mr')}, {r9('mf')}, CAST(n AS BIGINT) FROM g
UNION ALL SELECT {BY}, 'weighted avg', {r9('wp / CAST(n AS DOUBLE)')}, {r9('wr / CAST(n AS DOUBLE)')},
       {r9('wf / CAST(n AS DOUBLE)')}, CAST(n AS BIGINT) FROM g"""
ORACLE["multiclass_metrics"] = f"""WITH {_class_ctes()},
g AS (SELECT {BY}, SUM(tp) AS tp, SUM(support) AS n, SUM(precision * support) AS wp,
        SUM(recall * support) AS wr, SUM(f1_score * support) AS wf FROM cs WHERE support > 0 GROUP BY {BY})
SELECT {BY}, {r9('CAST(tp AS DOUBLE) / CAST(n AS DOUBLE)')} AS accuracy,
  {r9('wp / CAST(n AS DOUBLE)')} AS weighted_precision, {r9('wr / CAST(n AS DOUBLE)')} AS weighted_recall,
  {r9('wf / CAST(n AS DOUBLE)')} AS weighted_f1 FROM g"""
ORACLE["roc_curve"] = f"""WITH {_curve_ctes()}
SELECT {BY}, CAST(score AS DOUBLE) AS threshold,
  CASE WHEN N = 0 THEN NULL ELSE CAST(fp_cum AS DOUBLE) / CAST(N AS DOUBLE) END AS fpr,
  CASE WHEN P = 0 THEN NULL ELSE CAST(tp_cum AS DOUBLE) / CAST(P AS DOUBLE) END AS tpr FROM gc
UNION ALL SELECT DISTINCT {BY}, CAST('Infinity' AS DOUBLE), CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE) FROM gc"""
ORACLE["roc_auc"] = f"WITH {_curve_ctes()}\nSELECT {BY}, roc_auc FROM auc"
ORACLE["pr_curve"] = f"""WITH {_curve_ctes()}
SELECT {BY}, CAST(score AS DOUBLE) AS threshold,
  CASE WHEN tp_cum + fp_cum = 0 THEN NULL ELSE CAST(tp_cum AS DOUBLE) / CAST(tp_cum + fp_cum AS DOUBLE) END AS precision,
  CASE WHEN P = 0 THEN CAST(1.0 AS DOUBLE) ELSE CAST(tp_cum AS DOUBLE) / CAST(P AS DOUBLE) END AS recall FROM gc
UNION ALL SELECT DISTINCT {BY}, CAST(NULL AS DOUBLE), CAST(1.0 AS DOUBLE), CAST(0.0 AS DOUBLE) FROM gc"""
ORACLE["pr_auc"] = f"WITH {_curve_ctes()}\nSELECT {BY}, {r9('pr_auc')} AS pr_auc FROM auc WHERE pr_auc IS NOT NULL"
ORACLE["evaluate_all"] = _eval_long() + f"\nSELECT {BY}, metric, {r9('value')} AS value FROM ev"

# ---------------------------------------------------------------- SC / MO
ORACLE["positive_score"] = f"SELECT row_id, score FROM {BIN}"
ORACLE["score_labelled"] = f"""SELECT row_id, score, prediction,
  CASE WHEN prediction = 1 THEN 'Buy' ELSE 'Do not buy' END AS decision FROM {BIN}"""
_SPLIT_BATCH = _part("l_orderkey", [0.8, 0.2], ("train", "batch"))
ORACLE["score_batch_prepare"] = f"""WITH c AS (SELECT *, {_SPLIT_BATCH} AS split FROM {CLS3}),
s AS (SELECT {', '.join(f'avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s' for c in FEATS)} FROM c WHERE split = 'train')
SELECT c.l_orderkey, c.Target, {_Z} FROM c, s WHERE c.split = 'batch'"""
_CMP = _eval_long() + """,
t AS (SELECT * FROM ev WHERE dataset = 'test'),
bnd AS (SELECT model, min(version) AS v_old, max(version) AS v_new FROM t GROUP BY model),
o AS (SELECT t.model, t.metric, t.value AS old_value FROM t JOIN bnd ON t.model = bnd.model AND t.version = bnd.v_old
      WHERE t.metric IN ('accuracy', 'f1_score', 'roc_auc')),
nw AS (SELECT t.model, t.metric, t.value AS new_value FROM t JOIN bnd ON t.model = bnd.model AND t.version = bnd.v_new
      WHERE t.metric IN ('accuracy', 'f1_score', 'roc_auc')),
cmp AS (SELECT coalesce(nw.model, o.model) AS model, coalesce(nw.metric, o.metric) AS metric, o.old_value, nw.new_value,
          CASE WHEN o.old_value IS NOT NULL THEN coalesce(nw.new_value >= o.old_value AND NOT isnan(nw.new_value), false) END AS improved,
          CASE WHEN o.old_value IS NULL THEN 'metric not registered before' END AS note
        FROM nw FULL JOIN o ON nw.model = o.model AND nw.metric = o.metric)"""
ORACLE["compare_metrics"] = _CMP + f"""
SELECT model, metric, {r9('old_value')} AS old_value, {r9('new_value')} AS new_value, improved, note FROM cmp"""
ORACLE["retrain_decision"] = _CMP + """
SELECT model, CASE WHEN bool_or(improved = false) THEN 'retrain' ELSE 'keep' END AS decision FROM cmp GROUP BY model"""

# ---------------------------------------------------------------- LB
_MC_PREDS = f"""WITH {_class_ctes(PREDS)},
g AS (SELECT {BY}, SUM(tp) AS tp, SUM(support) AS n, SUM(precision * support) AS wp,
        SUM(recall * support) AS wr, SUM(f1_score * support) AS wf FROM cs WHERE support > 0 GROUP BY {BY}),
mc AS (SELECT {BY}, CAST(tp AS DOUBLE) / CAST(n AS DOUBLE) AS accuracy, wp / CAST(n AS DOUBLE) AS weighted_precision,
         wr / CAST(n AS DOUBLE) AS weighted_recall, wf / CAST(n AS DOUBLE) AS weighted_f1 FROM g),
board AS (SELECT model, version, {', '.join(
    r9(f"max({m}) FILTER (WHERE dataset = '{d}')") + f" AS {d}_{m}"
    for d in ('val', 'test') for m in ('accuracy', 'weighted_precision', 'weighted_recall', 'weighted_f1'))}
  FROM mc GROUP BY model, version)"""
ORACLE["leaderboard"] = _MC_PREDS + "\nSELECT * FROM board"
ORACLE["winner_by_accuracy"] = _MC_PREDS + "\nSELECT * FROM board ORDER BY test_accuracy DESC NULLS LAST, model, version LIMIT 1"
_MACRO = f"""WITH {_class_ctes(f"(SELECT * FROM {PREDS} WHERE dataset = 'test')", 'model, version')},
mb AS (SELECT model, version, avg(precision) AS mp, avg(recall) AS mr, avg(f1_score) AS mf
       FROM cs WHERE support > 0 GROUP BY model, version),
mb2 AS (SELECT model, version, mp, mr, mf, (mp + mr + mf) / CAST(3.0 AS DOUBLE) AS overall FROM mb)"""
ORACLE["leaderboard_macro"] = _MACRO + f"""
SELECT model, version, {r9('mp')} AS macro_precision, {r9('mr')} AS macro_recall, {r9('mf')} AS macro_f1,
  {r9('overall')} AS overall,
  CAST(row_number() OVER (ORDER BY overall DESC NULLS LAST, model, version) AS INTEGER) AS rank FROM mb2"""
ORACLE["winner_by_macro"] = _MACRO + f"""
SELECT model, version, {r9('mp')} AS macro_precision, {r9('mr')} AS macro_recall, {r9('mf')} AS macro_f1,
  {r9('overall')} AS overall FROM mb2 ORDER BY overall DESC NULLS LAST, model, version LIMIT 1"""
ORACLE["predicted_class_counts"] = f"SELECT prediction, CAST(COUNT(*) AS BIGINT) AS n_rows FROM {BIN} GROUP BY prediction"
ORACLE["roc_curve_dropped"] = f"""WITH {_curve_ctes()},
pts AS (SELECT *, lead(fp) OVER w AS nfp, lead(tp) OVER w AS ntp, row_number() OVER w AS rn
        FROM gc WINDOW w AS (PARTITION BY {BY} ORDER BY score DESC))
SELECT {BY}, CAST(score AS DOUBLE) AS threshold,
  CASE WHEN N = 0 THEN NULL ELSE CAST(fp_cum AS DOUBLE) / CAST(N AS DOUBLE) END AS fpr,
  CASE WHEN P = 0 THEN NULL ELSE CAST(tp_cum AS DOUBLE) / CAST(P AS DOUBLE) END AS tpr
FROM pts WHERE rn = 1 OR nfp IS NULL OR nfp <> fp OR ntp <> tp
UNION ALL SELECT DISTINCT {BY}, CAST('Infinity' AS DOUBLE), CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE) FROM gc"""
ORACLE["prediction_nulls"] = f"""SELECT {BY}, CAST(COUNT(*) AS BIGINT) AS n_rows,
  CAST(COUNT(*) FILTER (WHERE label IS NULL) AS BIGINT) AS null_label,
  CAST(COUNT(*) FILTER (WHERE prediction IS NULL) AS BIGINT) AS null_prediction,
  CAST(COUNT(*) FILTER (WHERE score IS NULL) AS BIGINT) AS null_score
FROM {PREDS} GROUP BY {BY}"""
ORACLE["score_batch_refit"] = f"""WITH c AS (SELECT *, {_SPLIT_BATCH} AS split FROM {CLS3}),
s AS (SELECT {', '.join(f'avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s' for c in FEATS)} FROM c WHERE split = 'batch')
SELECT c.l_orderkey, c.Target, {_Z} FROM c, s WHERE c.split = 'batch'"""


# ---------------------------------------------------------------- NaN, infinities, large integers
ORACLE["quantiles_bigint"] = """SELECT 'id' AS "column", p AS prob, 9007199254740992 + v AS value FROM (
  SELECT unnest([0.1, 0.25, 0.5, 0.75, 0.9]::DOUBLE[]) AS p,
         unnest(quantile_disc(event_id, [0.1, 0.25, 0.5, 0.75, 0.9])) AS v FROM events)"""
ORACLE["quantiles_inf"] = f"""WITH d AS (SELECT value, row_number() OVER (ORDER BY value) AS r, COUNT(*) OVER () AS n
  FROM {DIRTY} WHERE value IS NOT NULL AND NOT isnan(value)),
p AS (SELECT unnest([0.0, 0.05, 0.25, 0.5, 0.75, 1.0]::DOUBLE[]) AS prob)
SELECT 'value' AS "column", prob, value FROM p JOIN d ON r = greatest(ceil(n * prob), 1)"""
ORACLE["quantiles_approx"] = """SELECT c AS "column", p AS prob, true AS within_error
FROM (SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) AS c)
JOIN (SELECT unnest([0.25, 0.5, 0.75]::DOUBLE[]) AS p) ON true"""
ORACLE["flag_outliers_inf"] = f"""WITH d AS (SELECT event_id, value FROM {DIRTY}),
q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM d WHERE NOT isnan(value)),
f AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT event_id, CAST(coalesce(value < lo OR value > hi, false) AS INTEGER) AS value_is_outlier FROM d, f"""
DIRTY_FINITE = f"""(SELECT event_id, user_id, event_type, CASE WHEN abs(value) = 'Infinity'::DOUBLE THEN NULL ELSE value END AS value
  FROM {DIRTY})"""
_PRESENT = "CASE WHEN isnan(value) THEN NULL ELSE value END"
ORACLE["standard_scale_dirty"] = f"""WITH d AS (SELECT * FROM {DIRTY_FINITE}),
s AS (SELECT avg({_PRESENT}) AS m, stddev_pop({_PRESENT}) AS sd FROM d)
SELECT event_id, {r9('(value - m) / sd')} AS value FROM d, s"""
ORACLE["minmax_scale_dirty"] = f"""WITH d AS (SELECT * FROM {DIRTY_FINITE}),
s AS (SELECT min({_PRESENT}) AS lo, max({_PRESENT}) AS hi FROM d)
SELECT event_id, (value - lo) / (hi - lo) AS value FROM d, s"""
ORACLE["box_stats_dirty"] = f"""WITH d AS (SELECT {_PRESENT} AS x FROM {DIRTY_FINITE}),
q AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3 FROM d),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT 'value' AS "column", {r9('q1')} AS q1, {r9('median')} AS median, {r9('q3')} AS q3,
  (SELECT min(x) FROM d WHERE x >= lo) AS whisker_lo, (SELECT max(x) FROM d WHERE x <= hi) AS whisker_hi,
  (SELECT CAST(COUNT(*) AS BIGINT) FROM d WHERE x < lo OR x > hi) AS n_fliers FROM f"""
ORACLE["histogram_dirty"] = f"""WITH d AS (SELECT event_type, value, CASE WHEN NOT isnan(value) AND NOT isinf(value) THEN value END AS x
  FROM {DIRTY} WHERE value IS NOT NULL),
s AS (SELECT min(x) AS lo, max(x) AS hi FROM d),
b AS (SELECT event_type, CASE WHEN x IS NOT NULL THEN CAST(least(floor((x - lo) / (hi - lo) * 20.0::DOUBLE), 19) AS INTEGER) END AS bin FROM d, s)
SELECT event_type, bin, CAST(COUNT(*) AS BIGINT) AS n_rows,
  {r9('any_value(lo) + (any_value(hi) - any_value(lo)) * CAST(bin AS DOUBLE) / 20.0::DOUBLE')} AS bin_lo
FROM b, s GROUP BY event_type, bin"""
_CORR_COLS = ("value", "user_id", "event_id")
ORACLE["correlation_dirty"] = f"WITH d AS (SELECT event_id, user_id, {_PRESENT} AS value FROM {DIRTY_FINITE})\n" + \
    "\nUNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr FROM d"
        for a in _CORR_COLS for b in _CORR_COLS)
ORACLE["label_encode_new_rows"] = f"""WITH c AS (SELECT c_custkey, c_name, c_mktsegment,
    {_part('c_custkey', [0.8, 0.2], ('train', 'batch'))} AS split FROM customer),
n AS (SELECT c_name AS v, CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT c_name FROM c WHERE split = 'train')),
m AS (SELECT c_mktsegment AS v, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS code
      FROM (SELECT DISTINCT c_mktsegment FROM c WHERE split = 'train'))
SELECT c_custkey, m.code AS c_mktsegment, n.code AS c_name FROM c LEFT JOIN n ON n.v = c_name LEFT JOIN m ON m.v = c_mktsegment
WHERE split = 'batch'"""

# ---------------------------------------------------------------- models: the label is a rule that trees learn exactly
SEP = """(SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity <= 17 THEN 1 WHEN l_quantity <= 34 THEN 2 ELSE 3 END AS cls
  FROM lineitem)"""
_EXACT = "SELECT l_orderkey, l_linenumber, CAST({y} AS INTEGER) AS label, CAST({y} AS INTEGER) AS prediction FROM " + SEP
for _key in ("train_tree", "train_forest", "train_gbt_ovr", "tune_cv", "tune_tvs", "tune_gbt_ovr"):
    ORACLE[_key] = _EXACT.format(y="cls - 1")
ORACLE["train_gbt"] = _EXACT.format(y="(cls = 1)")
ORACLE["batch_score"] = f"SELECT l_orderkey, l_linenumber, CAST(cls AS INTEGER) AS Target, CAST(cls AS INTEGER) AS prediction FROM {SEP}"
ORACLE["train_logistic"] = "SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, true AS above_majority FROM lineitem"
ORACLE["train_weighted"] = f"SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, true AS auc_above_half FROM {BINARY_REAL}"
ORACLE["model_roundtrip_scores"] = "SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_differing FROM lineitem"
_SEP_PARTS = f"(SELECT *, {_part('l_orderkey', [0.8, 0.1, 0.1], THREE)} AS part FROM {SEP})"
ORACLE["train_suite"] = f"""WITH p AS (SELECT part AS dataset, CAST(COUNT(*) AS BIGINT) AS n_rows FROM {_SEP_PARTS} WHERE part <> 'train' GROUP BY part)
SELECT m AS model, dataset, n_rows, true AS above_majority, CASE WHEN m <> 'logistic' THEN CAST(0 AS BIGINT) END AS n_wrong
FROM p JOIN (SELECT unnest(['logistic', 'tree', 'forest']) AS m) ON true"""
ORACLE["train_champion"] = """SELECT m AS model, d AS dataset, e AS metric, CAST(1.0 AS DOUBLE) AS value, m = 'tree' AS champion
FROM (SELECT unnest(['tree', 'forest']) AS m) JOIN (SELECT unnest(['test', 'val']) AS d) ON true
JOIN (SELECT unnest(['accuracy', 'f1_score', 'roc_auc']) AS e) ON true"""
ORACLE["evaluate_current"] = """SELECT 'tree' AS model, 1 AS version, 'all' AS dataset, e AS metric, CAST(1.0 AS DOUBLE) AS value
FROM (SELECT unnest(['accuracy', 'precision', 'recall', 'f1_score', 'roc_auc', 'pr_auc']) AS e)"""
ORACLE["retrain_if_needed"] = _CMP + f""",
failed AS (SELECT model FROM cmp GROUP BY model HAVING bool_or(improved = false) ORDER BY model LIMIT 1)
SELECT model, CAST(max(version) + 1 AS INTEGER) AS version, CAST(1.0 AS DOUBLE) AS accuracy, CAST(1.0 AS DOUBLE) AS f1_score,
       CAST(1.0 AS DOUBLE) AS roc_auc FROM {PREDS} WHERE model IN (SELECT model FROM failed) GROUP BY model"""
ORACLE["lifecycle_leaderboard"] = "SELECT m AS model, 1 AS version, " + ", ".join(
    f"CAST(1.0 AS DOUBLE) AS {d}_{e}" for d in ("val", "test")
    for e in ("accuracy", "weighted_precision", "weighted_recall", "weighted_f1")) + \
    " FROM (SELECT unnest(['tree', 'forest']) AS m)"
ORACLE["scoring_lifecycle"] = f"""SELECT l_orderkey, CAST(cls = 1 AS DOUBLE) AS score, CAST(cls = 1 AS INTEGER) AS prediction,
  CASE WHEN cls = 1 THEN 'Buy' ELSE 'Do not buy' END AS decision
FROM (SELECT *, {_part('l_orderkey', [0.8, 0.2], ('train', 'batch'))} AS part FROM {SEP}) WHERE part = 'batch'"""
