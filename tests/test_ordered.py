import numpy as np
import pandas as pd

from tabulon.plans import ordered


def test_running_sums_match_pandas_with_hot_key(spark):
    rng = np.random.default_rng(1)
    # key 'hot' holds most rows: the scan must still be split into chunks
    keys = np.where(rng.random(3000) < 0.7, "hot", rng.choice(["a", "b", "c"], 3000))
    pdf = pd.DataFrame({"k": keys, "o": rng.permutation(3000), "v": rng.integers(0, 10, 3000)})
    df = spark.createDataFrame(pdf)
    out = ordered.running_sums(df, ["k"], [("o", False)], ["v"], num_chunks=7).toPandas()
    exp = pdf.sort_values(["k", "o"]).assign(v_cum=lambda d: d.groupby("k")["v"].cumsum())
    merged = out.merge(exp, on=["k", "o"], suffixes=("", "_exp"))
    assert len(merged) == 3000
    assert (merged["v_cum"] == merged["v_cum_exp"]).all()


def test_descending_global_running_sum(spark):
    pdf = pd.DataFrame({"s": np.arange(100, dtype=float), "v": np.ones(100, dtype=int)})
    out = ordered.running_sums(spark.createDataFrame(pdf), [], [("s", True)], ["v"],
                               num_chunks=5).toPandas()
    # the highest score is first
    assert dict(zip(out["s"], out["v_cum"]))[99.0] == 1
    assert dict(zip(out["s"], out["v_cum"]))[0.0] == 100


def test_forward_fill_matches_pandas(spark):
    rng = np.random.default_rng(5)
    n = 2000
    vals = rng.normal(size=n)
    vals[rng.random(n) < 0.6] = np.nan
    pdf = pd.DataFrame({"g": rng.choice(["x", "y"], n), "t": rng.permutation(n), "v": vals})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "g string, t long, v double")
    out = ordered.forward_fill(df, ["v"], "t", ["g"], num_chunks=9).toPandas()
    exp = pdf.sort_values(["g", "t"]).assign(v=lambda d: d.groupby("g")["v"].ffill())
    merged = out.merge(exp, on=["g", "t"], suffixes=("", "_exp"))
    a, b = merged["v"].to_numpy(dtype=float), merged["v_exp"].to_numpy(dtype=float)
    assert np.array_equal(np.isnan(a), np.isnan(b))
    assert np.allclose(a[~np.isnan(a)], b[~np.isnan(b)])


def test_global_row_index_is_a_permutation(spark):
    df = spark.createDataFrame([(f"v{i:03d}",) for i in range(250)], "value string")
    out = ordered.global_row_index(df, [("value", False)], num_chunks=6).toPandas()
    assert sorted(out["row_index"]) == list(range(250))
    assert (out.sort_values("value")["row_index"].to_numpy() == np.arange(250)).all()


def test_next_values_across_chunks(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"k": rng.choice(["a", "b"], 500), "o": rng.permutation(500),
                        "v": rng.integers(0, 100, 500)})
    out = ordered.running_sums(spark.createDataFrame(pdf), ["k"], [("o", True)], ["v"], num_chunks=11,
                               following=("v",)).toPandas()
    exp = pdf.sort_values(["k", "o"], ascending=[True, False])
    exp["next_v"] = exp.groupby("k")["v"].shift(-1)
    merged = out.merge(exp, on=["k", "o"], suffixes=("", "_exp"))
    assert len(merged) == 500
    a, b = merged["next_v"].astype(float), merged["next_v_exp"].astype(float)
    assert ((a == b) | (a.isna() & b.isna())).all()


def test_null_keys_are_kept(spark):
    rows = [(None, 1, 5.0), (None, 2, None), ("a", 1, None), ("a", 2, 3.0), (None, 3, None)]
    df = spark.createDataFrame(rows, "k string, o long, v double")
    filled = {(r["k"], r["o"]): r["v"] for r in ordered.forward_fill(df, ["v"], "o", ["k"]).collect()}
    assert filled == {(None, 1): 5.0, (None, 2): 5.0, (None, 3): 5.0, ("a", 1): None, ("a", 2): 3.0}
    ones = df.withColumn("one", df["o"] * 0 + 1)
    sums = {(r["k"], r["o"]): r["one_cum"]
            for r in ordered.running_sums(ones, ["k"], [("o", False)], ["one"]).collect()}
    assert sums == {(None, 1): 1, (None, 2): 2, (None, 3): 3, ("a", 1): 1, ("a", 2): 2}


def test_hot_key_is_split_across_chunks(spark):
    from pyspark.sql import functions as F

    n = 20000
    df = spark.range(n).select(F.when(F.col("id") % 10 == 0, F.lit("cold")).otherwise(F.lit("hot"))
                               .alias("k"), F.col("id").alias("o"))
    ck = ordered.materialised(ordered._chunks(df, ["k"], [F.col("o").asc()], 8))
    sizes = [r["count"] for r in ck.groupBy(ordered.CHUNK).count().collect()]
    assert sum(sizes) == n
    # the hot key holds 90% of the rows but no chunk gets more than ~1/8 of them (+ slack)
    assert max(sizes) < 0.25 * n
    hot_chunks = ck.filter(F.col("k") == "hot").select(ordered.CHUNK).distinct().count()
    assert hot_chunks >= 6


def test_forward_fill_orders_ties_by_content(spark):
    """Two order values give more than two chunks, and the result does not depend on where rows lie."""
    from pyspark.sql import functions as F

    rows = [(t, k % 7, None if k % 3 else float(k % 5), k % 2) for k in range(600) for t in (1, 2)]
    rows += [(2, 9, None, 1)] * 500  # equal rows
    df = spark.createDataFrame(rows, "t int, a int, v double, b int")
    none_last = sorted(rows, key=lambda r: (r[0], r[1], (r[2] is None, r[2] or 0), r[3]))
    want, last = [], None
    for t, a, v, b in none_last:
        last = v if v is not None else last
        want.append((t, a, last, b))
    for parts in (1, 6):
        out = ordered.forward_fill(df.repartition(parts), ["v"], "t", num_chunks=12)
        assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)
    cols = [F.col(c).asc() for c in ("t", "a", "v", "b", "_place")]
    chunks = ordered._chunks(df.withColumn("_place", F.monotonically_increasing_id()), [], cols, 12)
    assert chunks.select(ordered.CHUNK).distinct().count() > 6
    equal = chunks.filter("a = 9").select(ordered.CHUNK).distinct().count()
    assert equal > 2


def test_carries_are_attached_without_moving_the_rows(spark):
    df = spark.range(5000).selectExpr("id % 3 AS k", "id AS o", "id % 5 AS v", "CASE WHEN id % 4 = 0 THEN id END AS w")
    for out in (ordered.running_sums(df, ["k"], [("o", False)], ["v"], totals=True, following=("v",)),
                ordered.forward_fill(df, ["w"], "o", ["k"])):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "Window" not in plan
