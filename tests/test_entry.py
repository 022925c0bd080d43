import os

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["lang", "n_rows", "share", "pct", "pct_2dp"]
    assert len(rows) > 0
    assert abs(sum(r["share"] for r in rows) - 1.0) < 1e-9


def test_catalog_and_oracle_keys(spark):
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 90


def test_cheap_queries_run_on_smoke_data(spark):
    q = E.queries()
    for name in ["class_counts", "binary_metrics", "roc_auc", "confusion_matrix", "infinite_counts",
                 "forward_fill", "label_encode", "leaderboard"]:
        assert q[name](spark, SF_SMALL).count() >= 0


def test_no_reference_to_local_tmp_in_library():
    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tabulon")
    for dirpath, _, files in os.walk(root):
        for f in files:
            if f.endswith(".py"):
                text = open(os.path.join(dirpath, f)).read()
                assert ".localCheckpoint(" not in text
