"""Layout rewrites: partition counts, a persisted base shared by several
outputs, small-file compaction, multi-column (Z-order) clustering and
partition-pruned scans.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def fan_out(base: DataFrame, outputs: Mapping[str, Callable[[DataFrame], DataFrame]],
            root: str) -> dict[str, DataFrame]:
    """Persist ``base`` once, write every derived output, then unpersist.

    MEMORY_AND_DISK keeps the partitions that do not fit in memory on local
    disk rather than recomputing them; each output is read back from storage,
    so no caller depends on the cache after it is dropped.
    """
    base = base.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for name, build in outputs.items():
            build(base).write.mode("overwrite").parquet(f"{root}/{name}")
    finally:
        base.unpersist()
    spark = base.sparkSession
    return {name: spark.read.parquet(f"{root}/{name}") for name in outputs}


def partitions_for(total_bytes: int, target_bytes: int = 128 * 1024 * 1024) -> int:
    """How many partitions, files or buckets ``total_bytes`` make at about ``target_bytes`` each."""
    return max(1, math.ceil(total_bytes / target_bytes))


def partition_report(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Rows of each partition as it would be processed: ``partition, n_rows``
    and the sums of ``columns``; empty partitions have no row."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.count(F.lit(1)).alias("n_rows"), *(F.sum(c).alias(f"sum_{c}") for c in columns))


def resized(df: DataFrame, total_bytes: int, target_bytes: int = 128 * 1024 * 1024, now: int | None = None) -> DataFrame:
    """``df`` in as many partitions as its bytes make: fewer of ``now`` by
    ``coalesce`` (no shuffle), else evenly dealt by ``repartition``."""
    n = partitions_for(total_bytes, target_bytes)
    return df.coalesce(n) if now is not None and n <= now else df.repartition(n)


def dir_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (via the Hadoop FileSystem API)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength())


def compact(spark: SparkSession, src: str, dst: str, target_bytes: int = 128 * 1024 * 1024,
            fmt: str = "parquet") -> int:
    """Rewrite ``src`` into ``ceil(bytes / target)`` files at ``dst`` (row set
    unchanged); returns the file count chosen."""
    n = partitions_for(dir_bytes(spark, src), target_bytes)
    spark.read.format(fmt).load(src).repartition(n).write.mode("overwrite").format(fmt).save(dst)
    return n


def _interleave(a: Column, b: Column, bits: int) -> Column:
    z = F.lit(0).cast("long")
    for i in range(bits):
        z = z.bitwiseOR(F.shiftleft(F.shiftright(a, i).bitwiseAND(1), 2 * i))
        z = z.bitwiseOR(F.shiftleft(F.shiftright(b, i).bitwiseAND(1), 2 * i + 1))
    return z


def zorder(df: DataFrame, cols: Sequence[str], partitions: int, bits: int = 10) -> DataFrame:
    """Cluster rows by a Z-order key over two columns.

    Each column is scaled to ``bits`` bits between its min and max (scalar
    subqueries, no global sort), the bucket ids are bit-interleaved, then rows
    are range-partitioned and sorted by the key: each output file covers a
    compact box in both columns, so min/max statistics prune on either.
    """
    assert len(cols) == 2, "two clustering columns"
    top = (1 << bits) - 1
    ids = []
    for c in cols:
        x = F.col(c).cast("double")
        lo, hi = df.agg(F.min(x)).scalar(), df.agg(F.max(x)).scalar()
        ids.append(F.coalesce(F.least(F.lit(top), F.floor(F.try_divide(x - lo, hi - lo) * top)), F.lit(0)).cast("long"))
    keyed = df.withColumn("_z", _interleave(ids[0], ids[1], bits))
    return keyed.repartitionByRange(partitions, "_z").sortWithinPartitions("_z").drop("_z")


def pruned_read(spark: SparkSession, path: str, where: Column, fmt: str = "parquet") -> DataFrame:
    """Read with a predicate Catalyst turns into partition filters (on the
    partition columns) and pushed row-group filters (on data columns)."""
    return spark.read.format(fmt).load(path).where(where)
