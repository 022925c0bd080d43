"""Session construction and shared-storage helpers.

Lineage is cut with reliable ``checkpoint()`` into the folder the cluster names in
``spark.checkpoint.dir``. Only when that setting is absent *and* Spark runs in local mode
(tests, benches) do we create a folder of our own.

Intermediate tables lie below that folder. The DataFrames that operators return read them, so only
the caller knows when they are no longer needed: ``scratch_scope`` deletes what was written inside.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "tabulon",
                  shuffle_partitions: int | None = None, driver_memory: str = "16g",
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session tuned for the operators in this package."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        # reliable checkpoints of the ordered scans are deleted once unreferenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: float, total_cores: int,
                 partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a large cluster, sized from the input volume and the number of cores.

    Scan splits and shuffle partitions target ``partition_bytes`` each (well inside an
    executor core's share of memory, so sorts and hash aggregations do not spill much);
    AQE starts from enough partitions for the whole input and coalesces the small ones;
    skewed join partitions above 4x the median (and 1 GiB) are split; a join side is
    broadcast only when its materialised size is below 64 MiB. Use with
    ``build_session(master=..., extra=cluster_conf(...))``."""
    # map statuses grow with map tasks x reducers: cap reducers at 4x cores; most shuffles
    # here follow a map-side partial aggregation and are far smaller than the input
    initial = min(max(2 * total_cores, int(input_bytes // partition_bytes) + 1), 4 * total_cores)
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def _is_local(spark: SparkSession) -> bool:
    """One JVM: executors of a ``local-cluster`` have folders of their own."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the SparkContext.

    On a cluster the folder must be configured (``spark.checkpoint.dir``); a machine-local
    temporary folder is only created in local mode.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="tabulon-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Eager, reliable checkpoint into the shared folder (never a local one): survives
    executor loss."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tabulon-scratch/{uuid.uuid4().hex}/{name}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


def delete_scratch(spark: SparkSession, path: str) -> None:
    """Delete a table that was written to a ``scratch_path``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Intermediate tables that are written inside are deleted at the end, also after an error. Write
    the result inside, to a path of your own: a lazy result would read what is gone."""
    _SCOPES.append(paths := [])
    try:
        yield
    finally:
        del _SCOPES[next(k for k, scope in enumerate(_SCOPES) if scope is paths)]
        for path in paths:
            delete_scratch(spark, path)
