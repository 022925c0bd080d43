import math

import numpy as np

from pyspark.sql import functions as F

from tabulon.operators import clean, outliers, profile


def _dirty(spark):
    rows = [(1, 1.0, "a"), (2, None, None), (3, float("nan"), "b"), (4, float("inf"), "b"),
            (5, float("-inf"), "c"), (6, 2.0, "c")]
    return spark.createDataFrame(rows, "id long, x double, s string")


def test_infinite_missing_null_counts(spark):
    df = _dirty(spark)
    inf = {r["column"]: r["n_infinite"] for r in profile.infinite_counts(df).collect()}
    assert inf == {"x": 2}
    miss = {r["column"]: (r["n_missing"], r["kind"]) for r in profile.missing_columns(df).collect()}
    assert miss == {"x": (2, "numeric"), "s": (1, "categorical")}
    nulls = {r["column"]: r["n_null"] for r in profile.null_counts(df).collect()}
    assert nulls == {"id": 0, "x": 1, "s": 1}


def test_profiles_on_empty_table(spark):
    empty = spark.createDataFrame([], "x double, s string")
    assert profile.infinite_counts(empty).count() == 0
    assert profile.missing_columns(empty).count() == 0
    assert {r["n_null"] for r in profile.null_counts(empty).collect()} == {0}


def test_fill_missing_and_cast(spark):
    df = _dirty(spark)
    filled = {r["id"]: r["x"] for r in clean.fill_missing(df, ["x"], 0).collect()}
    assert filled[2] == 0 and filled[3] == 0 and filled[4] == float("inf")
    txt = spark.createDataFrame([("1.5",), ("9.899.999",), (None,)], "raw string")
    got = [r["raw"] for r in clean.cast_columns(txt, {"raw": "double"}).collect()]
    assert got == [1.5, None, None]


def test_correlation_constant_and_null_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0, None), (2.0, 5.0, 4.0, 1.0), (3.0, 5.0, 6.5, 2.0)],
                               "a double, c double, b double, n double")
    m = {(r["col_a"], r["col_b"]): r["corr"]
         for r in profile.correlation_matrix(df, ["a", "c", "b", "n"]).collect()}
    assert m[("a", "c")] is None and m[("c", "c")] is None
    assert m[("a", "a")] == 1.0 or abs(m[("a", "a")] - 1.0) < 1e-12
    assert m[("a", "n")] == 1.0 or abs(m[("a", "n")] - 1.0) < 1e-12  # pairwise complete rows
    assert m[("a", "b")] == m[("b", "a")]


def test_histogram_constant_column_and_last_bin(spark):
    df = spark.createDataFrame([(1, 0.0), (1, 10.0), (2, 5.0)], "g int, x double")
    h = {(r["g"], r["bin"]): r["n_rows"] for r in profile.histogram_by(df, "x", "g", 10).collect()}
    assert h == {(1, 0): 1, (1, 9): 1, (2, 5): 1}
    const = spark.createDataFrame([(1, 3.0), (2, 3.0)], "g int, x double")
    assert {r["bin"] for r in profile.histogram_by(const, "x", "g").collect()} == {0}


def test_high_cardinality_counts_null_group(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "s string")
    r = profile.high_cardinality(df, ["s"], threshold=2).collect()[0]
    assert r["n_groups"] == 3 and r["is_high"]


def test_class_distribution_and_frequency(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (3,)], "t int")
    d = {r["t"]: (r["n_rows"], r["share"]) for r in profile.class_distribution(df, "t").collect()}
    assert d == {1: (2, 0.5), 2: (1, 0.25), 3: (1, 0.25)}


def test_outlier_flags_null_and_nan(spark):
    rows = [(float(i),) for i in range(20)] + [(1000.0,), (None,), (float("nan"),)]
    df = spark.createDataFrame(rows, "x double")
    flagged = outliers.flag_outliers(df, ["x"]).collect()
    flags = {(None if r["x"] is None else ("nan" if math.isnan(r["x"]) else r["x"])): r["x_is_outlier"]
             for r in flagged}
    assert flags[1000.0] == 1 and flags[None] == 0 and flags["nan"] == 1 and flags[5.0] == 0
    kept = outliers.remove_outliers(df, ["x"])
    assert kept.count() == 21  # 20 inliers + the NULL row
    counts = {r["column"]: r["n_outliers"] for r in outliers.outlier_counts(df, ["x"]).collect()}
    assert counts == {"x": 2}


def test_impute_max_and_mode(spark):
    rows = [("d", "g", 1), ("d", "g", 3), ("d", "g", 3), ("d", "g", None), ("d", "h", None),
            ("e", "g", 2), ("e", "g", 2), ("e", "g", 5), ("e", "g", 5), ("e", "g", None)]
    df = spark.createDataFrame(rows, "p string, g string, v long")
    mx = clean.impute_by_group(df, ["p", "g"], "v", "max")
    assert sorted(r["v"] for r in mx.filter(F.col("p") == "d").collect() if r["g"] == "g") == [1, 3, 3, 3]
    md = clean.impute_by_group(df, ["p", "g"], "v", "mode").collect()
    filled = sorted((r["p"], r["g"], r["v"]) for r in md)
    assert ("e", "g", 2) in filled and filled.count(("e", "g", 2)) == 3  # tie -> smallest
    assert ("d", "h", None) in filled  # a group without values stays NULL


def test_wide_table_profiles_are_batched(spark, monkeypatch):
    from tabulon.plans import multicolumn

    monkeypatch.setattr(multicolumn, "MAX_AGGREGATES", 3)
    cols = [f"c{i}" for i in range(10)]
    df = spark.createDataFrame([tuple(float(i * j) if j % 3 else None for j in range(10))
                                for i in range(5)], ", ".join(f"{c} double" for c in cols))
    nulls = {r["column"]: r["n_null"] for r in profile.null_counts(df).collect()}
    assert nulls == {c: (5 if j % 3 == 0 else 0) for j, c in enumerate(cols)}


def test_nan_is_missing_in_statistics(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (nan, 0.0), (4.0, None), (3.0, 5.9)], "x double, y double")
    corr = {(r["col_a"], r["col_b"]): r["corr"] for r in profile.correlation_matrix(df, ["x", "y"]).collect()}
    want = np.corrcoef([1.0, 2.0, 3.0], [2.0, 4.1, 5.9])[0, 1]
    assert abs(corr["x", "y"] - want) < 1e-12 and corr["x", "x"] == 1.0
    assert profile.target_correlation(df, "y", ["x", "y"]).count() == 1
    box = profile.box_stats(df, ["x"]).first()
    assert box["n_fliers"] == 0 and box["median"] == 2.5
    odd = spark.createDataFrame([(1.0, "a"), (3.0, "a"), (nan, "a"), (inf, "a"), (None, "a")], "v double, g string")
    bins = {r["bin"]: r["n_rows"] for r in profile.histogram_by(odd, "v", "g", bins=2).collect()}
    assert bins == {0: 1, 1: 1, None: 2}


def test_wide_correlation_is_quick(spark):
    from pyspark.sql import functions as F

    df = spark.range(1000).select(*[F.rand(i).alias(f"c{i}") for i in range(100)], F.lit(5.0).alias("same"))
    found = profile.correlation_matrix(df, df.columns).collect()
    assert len(found) == 101 * 101
    assert {r["corr"] for r in found if "same" in (r["col_a"], r["col_b"])} == {None}


def test_infinite_quartiles_flag_nothing(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1.0,), (2.0,), (inf,), (inf,)], "x double")
    assert outliers.remove_outliers(df, ["x"]).count() == 4
    assert {r[0] for r in outliers.flag_outliers(df, ["x"]).select("x_is_outlier").collect()} == {0}


def test_correlation_in_tiles_and_target_sums_agree_with_pandas(spark):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 9)) @ rng.normal(size=(9, 9)) + 1e4
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 7] = 3.1
    names = [f"c{i}" for i in range(9)]
    pdf = pd.DataFrame(x, columns=names)
    df = spark.createDataFrame(pdf).repartition(3)
    want = pdf.corr().to_numpy(copy=True)
    want[7, :] = want[:, 7] = np.nan
    for tile in (4, 100):
        out = profile.correlation_matrix(df, names, tile=tile).collect()
        assert len(out) == 81
        got = {(r["col_a"], r["col_b"]): r["corr"] for r in out}
        for i, a in enumerate(names):
            for j, b in enumerate(names):
                v = got[a, b]
                assert (v is None) == bool(np.isnan(want[i, j])) and (v is None or abs(v - want[i, j]) < 1e-9)
    near = profile.target_correlation(df, "c2", names).collect()
    assert [r["corr"] for r in near] == sorted(r["corr"] for r in near) and len(near) == 7
    assert all(abs(r["corr"] - want[2, names.index(r["column"])]) < 1e-9 for r in near)
    empty = df.limit(0)
    assert {r["corr"] for r in profile.correlation_matrix(empty, names, tile=4).collect()} == {None}
    assert profile.target_correlation(empty, "c2", names).count() == 0


def test_class_totals_need_no_window(spark):
    from tabulon.operators import split

    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    for out in (profile.class_distribution(df, "k"), split.class_weight_table(df, "k")):
        assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r["k"]: r["share"] for r in profile.class_distribution(df, "k").collect()} == {"a": 0.5, "b": 0.25, None: 0.25}
    assert profile.class_distribution(df.limit(0), "k").count() == 0
    assert split.class_weights(df.limit(0), "k").count() == 0
