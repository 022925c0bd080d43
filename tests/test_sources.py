import os
import tempfile

from tabulon.sources import files, metrics_store


def test_read_delimited_leading_dot_and_malformed(spark):
    folder = tempfile.mkdtemp(prefix="tabulon-csv-")
    path = os.path.join(folder, "data.csv")
    with open(path, "w") as fh:
        fh.write("key;width;count;share\n")
        fh.write("1;7.5;12;0.25\n")
        fh.write("2;.5;40;1.2.3\n")
        fh.write("3;8.0;;.38\n")
    df = files.read_delimited(spark, path, types={"key": "int", "width": "double", "count": "int", "share": "double"})
    rows = {r["key"]: r for r in df.collect()}
    assert rows[2]["width"] == 0.5
    assert rows[2]["share"] is None          # malformed number -> NULL, no failure
    assert rows[3]["count"] is None          # empty field
    assert rows[3]["share"] == 0.38
    assert dict(df.dtypes) == {"key": "int", "width": "double", "count": "int", "share": "double"}


def test_parquet_roundtrip_and_projection(spark):
    folder = tempfile.mkdtemp(prefix="tabulon-pq-")
    df = spark.createDataFrame([(1, "a", 2.0), (2, "b", 3.0)], "id int, s string, x double")
    files.write_table(df, folder, mode="overwrite")
    back = files.read_table(spark, folder, ["id", "x"])
    assert back.columns == ["id", "x"]
    assert sorted(tuple(r) for r in back.collect()) == [(1, 2.0), (2, 3.0)]


def test_metric_log_is_keyed_by_run_and_pivots(spark):
    folder = tempfile.mkdtemp(prefix="tabulon-metrics-")
    rows = [("m", 1, "test", "accuracy", 0.9), ("m", 1, "test", "f1_score", 0.8)]
    df = spark.createDataFrame(rows, "model string, version int, dataset string, metric string, value double")
    again = df.withColumn("version", df["version"] + 1)
    metrics_store.log_metrics(df, folder, "007")
    metrics_store.log_metrics(again, folder, "b/1 x")
    once = sorted(map(tuple, metrics_store.read_metrics(spark, folder).collect()))
    for _ in range(2):  # a repeated run leaves the same rows
        metrics_store.log_metrics(again, folder, "b/1 x")
        assert sorted(map(tuple, metrics_store.read_metrics(spark, folder).collect())) == once
    assert len(once) == 4 and {r[-1] for r in once} == {"007", "b/1 x"}
    # fewer rows of a run replace all of its rows, and no others
    metrics_store.log_metrics(again.filter("metric = 'accuracy'"), folder, "b/1 x")
    log = metrics_store.read_metrics(spark, folder)
    assert log.count() == 3 and metrics_store.read_run(spark, folder, "007").count() == 2
    wide = {r["version"]: r for r in metrics_store.metrics_for(log, metrics=["accuracy", "f1_score", "roc_auc"]).collect()}
    assert wide[2]["accuracy"] == 0.9 and wide[2]["roc_auc"] is None
    # the last run's value holds where several logged one
    metrics_store.log_metrics(df.withColumn("value", df["value"] / 2), folder, "008")
    log = metrics_store.read_metrics(spark, folder)
    assert metrics_store.metrics_for(log, metrics=["accuracy"]).filter("version = 1").first()["accuracy"] == 0.45


def test_read_delimited_with_explicit_schema(spark):
    from pyspark.sql import types as T

    folder = tempfile.mkdtemp(prefix="tabulon-csv-")
    path = os.path.join(folder, "rows.csv")
    with open(path, "w") as fh:
        fh.write("a;b\n1.5;x\n;y\n")
    schema = T.StructType([T.StructField("a", T.DoubleType()), T.StructField("b", T.StringType())])
    rows = files.read_delimited(spark, path, schema=schema).collect()
    assert [(r["a"], r["b"]) for r in rows] == [(1.5, "x"), (None, "y")]


def test_scratch_tables_are_deleted_with_their_scope(spark):
    from tabulon import session
    from tabulon.plans import lookup

    def local(path):
        return path.removeprefix("file:")

    kept = session.scratch_path(spark, "kept")
    try:
        with session.scratch_scope(spark):
            outer = session.scratch_path(spark, "outer")
            spark.range(3).write.parquet(outer)
            with session.scratch_scope(spark):
                inner = lookup.materialised(spark.range(5)).inputFiles()
                spark.range(2).write.parquet(kept)
            assert os.path.exists(local(outer)) and not os.path.exists(local(os.path.dirname(inner[0])))
            raise KeyError
    except KeyError:
        pass
    assert not os.path.exists(local(outer)) and spark.read.parquet(kept).count() == 2
    session.delete_scratch(spark, kept)
    assert not os.path.exists(local(kept)) and not session._SCOPES


def test_only_one_jvm_counts_as_local(monkeypatch):
    from types import SimpleNamespace

    from tabulon import session

    def local(master):
        return session._is_local(SimpleNamespace(sparkContext=SimpleNamespace(master=master)))

    assert local("local") and local("local[4]") and local("local[*]")
    assert not local("local-cluster[2,1,1024]") and not local("yarn")
