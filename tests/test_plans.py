"""Physical-plan invariants: filters and column pruning reach the Parquet scan, small lookups are
broadcast (``test_oracle.py`` also checks every key's plan)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_outlier_filter_is_pushed_into_scan(spark):
    plan = _plan(E.queries()["flagship_iqr_lang_share"](spark, SF_SMALL))
    assert "PushedFilters: [Or(IsNull(n_chars),And(GreaterThanOrEqual(n_chars," in plan


def test_projection_is_pruned_in_scan(spark):
    plan = _plan(E.queries()["io_parquet_project"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_profiles_are_one_aggregation(spark):
    plan = _plan(E.queries()["missing_columns"](spark, SF_SMALL))
    # one partial + one final aggregate over a single scan
    assert plan.count("HashAggregate") == 2 and plan.count("FileScan") == 1


@pytest.mark.parametrize("name", ["class_weights", "join_class_counts", "impute_group_max", "latest_version",
                                  "join_frequency_left"])
def test_rows_are_not_shuffled_for_a_small_lookup(spark, name):
    """Also where the planner's own size estimate would not broadcast: the lookup is written first."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(E.queries()[name](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
