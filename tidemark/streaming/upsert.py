"""A keyed table that a change stream keeps up to date.

``KeyedSnapshot`` holds the newest row of every key in hash buckets. A
micro-batch rewrites just the buckets that its keys fall into: their rows and
the batch's newest change per key are merged into new bucket folders, and then
one row per bucket goes into a ledger. Readers follow the ledger, so they see a
batch whole or not at all:

* a batch that broke off before its ledger entry is not seen, and its retry
  overwrites the same folders;
* a batch id that is in the ledger is skipped, so a replayed batch (a restart
  after the entry, before the stream's own commit) changes nothing.

Work per batch is the touched buckets, not the table. Deleted keys stay as
tombstones with their sequence, so that an older change that arrives later does
not bring them back. One writer at a time, as a stream's checkpoint ensures.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.layout import partitions_for

BUCKET_BYTES = 256 * 1024 * 1024


def buckets_for(total_bytes: int) -> int:
    """Buckets for a table of about ``total_bytes``."""
    return partitions_for(total_bytes, BUCKET_BYTES)


class KeyedSnapshot:
    """The table at ``path``. ``sequence_by`` orders the changes of a key;
    ``buckets`` is fixed when the table is made."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], sequence_by: Sequence[str], buckets: int):
        self.spark, self.path, self.keys, self.sequence_by, self.buckets = spark, path, list(keys), list(sequence_by), buckets

    def ledger(self) -> DataFrame | None:
        """``_batch, _bucket, n_rows`` of every applied batch (NULL bucket: it had no rows)."""
        try:
            return self.spark.read.schema("_bucket int, n_rows long, _batch long").option("basePath", f"{self.path}/ledger").parquet(f"{self.path}/ledger")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                return None
            raise

    def applied(self, batch_id: int) -> bool:
        seen = self.ledger()
        return seen is not None and not seen.where(F.col("_batch") == batch_id).isEmpty()

    def _stored(self, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """The current rows, tombstones too, of some buckets or all."""
        seen = self.ledger()
        if seen is None:
            return None
        now = seen.where("_bucket IS NOT NULL").groupBy("_bucket").agg(F.max("_batch").alias("b"))
        if buckets is not None:
            now = now.where(F.col("_bucket").isin(list(buckets)))
        paths = [f"{self.path}/state/_batch={r['b']}/_bucket={r['_bucket']}" for r in now.collect()]       # bounded: one row a bucket
        return self.spark.read.option("basePath", f"{self.path}/state").parquet(*paths).drop("_batch") if paths else None

    def read(self, drop: Sequence[str] = ()) -> DataFrame:
        """The table: one row per key that is not deleted."""
        rows = self._stored()
        if rows is None:
            raise ValueError(f"no batch has been applied to {self.path}")
        return rows.where("NOT _deleted").drop("_deleted", "_bucket", *drop)

    def _newest(self, rows: DataFrame) -> DataFrame:
        # a change of the batch wins over a stored row of equal sequence
        order = [F.col(c).desc() for c in [*self.sequence_by, "_new"]]
        turn = F.row_number().over(Window.partitionBy("_bucket", *self.keys).orderBy(*order))
        return rows.withColumn("_rn", turn).where("_rn = 1").drop("_rn")

    def apply(self, changes: DataFrame, batch_id: int, deletes: str | Column | None = None) -> bool:
        """Merge a batch of changes; False if it has been applied before."""
        if self.applied(batch_id):
            return False
        gone = F.lit(False) if deletes is None else F.coalesce(F.expr(deletes) if isinstance(deletes, str) else deletes, F.lit(False))
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        # a hot key sends one row per task into the shuffle; kept as it is read for the buckets and for the merge
        batch = self._newest(changes.withColumns({"_deleted": gone, "_bucket": bucket, "_new": F.lit(1)})).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            touched = [r["_bucket"] for r in batch.select("_bucket").distinct().collect()]                # bounded: the buckets
            if touched:
                rows, stored = batch, self._stored(touched)
                if stored is not None:
                    rows = rows.unionByName(stored.withColumn("_new", F.lit(0)))
                # one bucket, one writer; the partitioning also serves the window
                merged = self._newest(rows.repartition(len(touched), "_bucket")).drop("_new")
                merged.write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/state/_batch={batch_id}")
            entry = batch.groupBy("_bucket").agg(F.count("*").alias("n_rows")) if touched else \
                self.spark.createDataFrame([(None, 0)], "_bucket int, n_rows long")
            entry.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/ledger/_batch={batch_id}")     # one file: there or not
        finally:
            batch.unpersist()
        return True


def upsert_stream(stream: DataFrame, table: KeyedSnapshot, checkpoint: str, deletes: str | Column | None = None, trigger: dict | None = None) -> int:
    """Run a change stream into ``table`` until the available input is used up; returns the batches applied."""
    applied = []

    def batch(changes: DataFrame, batch_id: int) -> None:
        if table.apply(changes, batch_id, deletes):
            applied.append(batch_id)

    q = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    q.awaitTermination()
    return len(applied)
