"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed to completion with the ``noop`` sink (the whole plan runs, nothing is
collected to the driver). Prints ONE JSON line with per-query seconds and Spark job counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "flagship_iqr_lang_share", "quantiles_exact", "box_stats", "outlier_recheck",
    "infinite_counts", "missing_columns", "correlation_matrix", "histogram_by_class",
    "impute_group_max", "impute_group_mode", "forward_fill", "label_encode", "string_index",
    "frequency_encode", "standard_scale", "feature_chain", "preprocess_chain",
    "class_weights", "evaluate_all", "roc_curve", "pr_curve", "classification_report",
    "leaderboard", "leaderboard_macro", "train_logistic", "train_tree", "feature_chain_new_rows", "preprocess_new_rows",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from tabulon.session import build_session
    from tabulon.plans.catalog import QUERIES

    import tempfile

    log_dir = tempfile.mkdtemp(prefix="tabulon-bench-events-")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus * 2,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 "spark.eventLog.compress": "false"})
    sc = spark.sparkContext
    names = [n for n in HEADLINE if n in QUERIES]
    # warm-up, not timed: JVM class loading / JIT of the scan, aggregation, selection and
    # join code paths, Parquet footers
    for warm in ("class_counts", "flagship_iqr_lang_share", "join_class_counts"):
        QUERIES[warm](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times, jobs = {}, {}
    for name in names:
        sc.setJobGroup(name, name)
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        jobs[name] = len(sc.statusTracker().getJobIdsForGroup(name))
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    spark.stop()
    actions = _actions_per_group(log_dir)
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "spark_jobs": jobs,
                      "actions": {n: actions.get(n, 0) for n in names}, "sf": sf, "cpus": cpus}))


def _actions_per_group(log_dir: str) -> dict[str, int]:
    """Distinct SQL executions (driver actions) per job group, read from the event log.
    AQE submits one Spark job per shuffle stage, so jobs overstate the number of passes."""
    groups: dict[str, set] = {}
    paths = [os.path.join(d, f) for d, _, fs in os.walk(log_dir) for f in fs]
    for path in paths:
        with open(path, errors="replace") as fh:
            for line in fh:
                if not line.startswith("{") or '"SparkListenerJobStart"' not in line:
                    continue
                props = json.loads(line).get("Properties", {})
                g, ex = props.get("spark.jobGroup.id"), props.get("spark.sql.execution.id")
                # jobs without an execution id read Parquet footers when a table is opened
                if g is not None and ex is not None:
                    # nested executions (e.g. AQE subqueries) share the root execution id
                    root = props.get("spark.sql.execution.root.id", ex)
                    groups.setdefault(g, set()).add(root)
    return {g: len(v) for g, v in groups.items()}


if __name__ == "__main__":
    main()
