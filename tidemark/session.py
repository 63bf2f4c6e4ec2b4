"""Session construction and shared-storage helpers.

Every operator in the library is a function ``DataFrame -> DataFrame``; this
module only builds a session with the settings the library assumes (AQE on,
UTC session zone, ANSI on) and hands out scratch locations that live under the
cluster's shared checkpoint folder, never under a machine-local temp dir.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Advisory shuffle partition size for AQE; large enough that a 100 TB job
# does not explode into millions of tiny tasks, small enough to fit in memory.
ADVISORY_PARTITION_BYTES = "256m"
MAX_PARTITION_BYTES = "128m"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tidemark", driver_memory: str | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session configured for the library.

    On a cluster, pass ``master=None`` and let spark-submit decide; shuffle
    partitions then default to Spark's setting and AQE coalesces them by the
    advisory size. Tests and the local benchmark pass a small number.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": ADVISORY_PARTITION_BYTES,
        "spark.sql.files.maxPartitionBytes": MAX_PARTITION_BYTES,
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.bucketing.enabled": "true",
        # session windows: merge sessions inside each map partition before the
        # shuffle, so a very active key does not send every event to one task
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_LOCAL_ROOT: str | None = None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Without the setting, a folder already registered with the context is used.
    Only on a local master -- a laptop or a test -- a private folder is created
    and registered; on a cluster that would be another folder on each machine,
    so it is an error there.
    """
    global _LOCAL_ROOT
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        if _LOCAL_ROOT is None:
            _LOCAL_ROOT = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        d = _LOCAL_ROOT
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = ensure_checkpoint_dir(spark)
    if root.startswith("file:"):
        root = root[len("file:"):]
    return os.path.join(root, "tidemark-scratch", f"{name}-{uuid.uuid4().hex[:12]}")


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Cut lineage by writing ``df`` as a parquet table in the shared
    checkpoint folder and reading it back.

    Survives executor loss (the data is in shared storage, unlike a local
    checkpoint), is columnar and compressed (cheaper than the row-serialized
    RDD checkpoint), and gives the planner real file statistics. What the
    write has shuffled is removed with it, not when the driver's garbage happens
    to be collected.
    """
    path, conf = scratch_path(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, None)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        conf.unset(SHUFFLE_CLEANUP) if before is None else conf.set(SHUFFLE_CLEANUP, before)
    return df.sparkSession.read.parquet(path)


def size_estimate_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimized plan (None if unavailable)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # pragma: no cover - connect mode has no _jdf
        return None


def input_bytes(df: DataFrame) -> int:
    """Bytes of the tables that ``df`` reads (one read twice counts twice). Unlike
    the estimate of a whole plan it does not multiply over joins; inputs of
    unknown size, such as rows handed over by the driver, count as nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return sum(n for n in sizes if n < 1 << 60)


BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def broadcast_if_small(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Broadcast-hint ``df`` only when its estimated size is under ``limit_bytes``.

    Beyond the limit the hint is not added and Catalyst/AQE choose a shuffle
    join (AQE may still convert to broadcast from runtime sizes).
    """
    est = size_estimate_bytes(df)
    if est is not None and est <= limit_bytes:
        return F.broadcast(df)
    return df


BROADCAST_MAX_ROWS = 1_000_000


def broadcast_bounded(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast a derived lookup only when its row count proves it small.

    For lookups built with DISTINCT/GROUP BY over big tables Catalyst's static
    estimate is the size of the big input; without a proven bound AQE could
    only switch to a broadcast after the big side had already been shuffled.
    The count is one partial-aggregated pass over the lookup's few columns;
    beyond ``max_rows`` no hint is added (a shuffle join).
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tidemark`` importable in the Python workers (UDFs, pandas UDFs,
    keyed state functions are pickled by reference to its modules).

    Zips the package once per SparkContext on the driver and registers it with
    ``addPyFile`` -- what ``--py-files`` does at submit time. Works with any
    checkpoint root, local or remote.
    """
    import zipfile
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    # the driver's own copy only: addPyFile hands the bytes to every executor
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-pyfiles-"), "tidemark.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    _SHIPPED.add(key)
