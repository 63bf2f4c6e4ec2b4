"""Structured Streaming plumbing: file-stream sources, checkpointed sinks and
a runner that drives a query to completion with ``availableNow``.

Sinks are exactly-once or idempotent: append streams use the file sink (its
commit log makes retries safe); update/complete streams use ``foreachBatch``
writing each micro-batch into its own ``_batch=<id>`` folder with overwrite,
so a retried batch replaces itself, and readers take the newest row per key.
Every query gets its own folder (source copy, checkpoint, sink) under the
shared checkpoint root.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.operators.layout import partitions_for
from tidemark.session import input_bytes, scratch_path

STAGED_BYTES = 128 * 1024 * 1024


def files_each(df: DataFrame, n: int) -> int:
    """How many files each of ``n`` parts of ``df`` is staged as, so that the
    task that writes one reads about ``STAGED_BYTES`` whatever the input. A
    rate limit of so many files a trigger leaves the number of batches as it is."""
    return partitions_for(-(-input_bytes(df) // n), STAGED_BYTES)


def stage_files(df: DataFrame, name: str, n_files: int = 8, order_by=None,
                fmt: str = "parquet", partition_by: Sequence[str] = ()) -> tuple[str, object]:
    """Write ``df`` as ``n_files`` files into a fresh folder to serve as a
    file-stream source. With ``order_by`` the files are ranges of that column,
    and their modification times follow them: a file stream takes the oldest
    files first, so event time then advances from batch to batch whatever the
    rate limit, and a watermark drops no row of the files."""
    path = scratch_path(df.sparkSession, name)
    out = df.repartitionByRange(n_files, order_by).sortWithinPartitions(order_by) if order_by is not None \
        else df.repartition(n_files)
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.format(fmt).save(path)
    if order_by is not None and not partition_by:
        _order_file_times(df.sparkSession, path)
    return path, df.schema


def _order_file_times(spark: SparkSession, path: str) -> None:
    """Give the data files of a folder increasing modification times in the
    order of their names, which is the order of the writing tasks. They end
    before now, so files that arrive later are newer."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files = sorted((f.getPath() for f in store.listStatus(folder) if f.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    start = int(time.time() * 1000) - 1000 * (len(files) + 1)
    for i, f in enumerate(files):
        store.setTimes(f, start + 1000 * i, -1)


def with_flush_row(df: DataFrame, ts: str, fill: dict, after: str = "1 day") -> DataFrame:
    """``df`` and rows whose time lies ``after`` the last one, so that a
    watermark passes every real row. ``fill`` gives a list of values for each
    column that is not NULL in them; queries drop these rows again."""
    spark, n = df.sparkSession, max(map(len, fill.values()))
    rows = spark.createDataFrame([tuple(v[i] for v in fill.values()) for i in range(n)], df.select(*fill).schema)
    last = df.agg((F.max(ts) + F.expr(f"INTERVAL {after}")).alias(ts))
    flush = rows.join(F.broadcast(last), how="inner") if ts not in fill else rows          # one row: a scalar
    return df.unionByName(flush, allowMissingColumns=True)


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                max_files: int | None = None, options: dict | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path)


def event_time(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Watermarks need TIMESTAMP; the tables carry TIMESTAMP_NTZ (UTC wall
    clock). With the session zone pinned to UTC the cast is lossless."""
    return df.withColumn(out or col, F.col(col).cast("timestamp"))


def to_ntz(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


class StreamRun:
    """A finished stream query: its sink folder, checkpoint and progress."""

    def __init__(self, spark, path, checkpoint, progress, mode, keys, run_id=None):
        self.spark, self.path, self.checkpoint, self.run_id = spark, path, checkpoint, run_id
        self.progress, self.mode, self.keys = progress, mode, keys

    def result(self) -> DataFrame:
        df = self.spark.read.parquet(self.path)
        if self.mode == "append":
            return df
        if self.mode == "complete":
            last = df.agg(F.max("_batch")).scalar()
            return df.where(F.col("_batch") == last).drop("_batch")
        w = Window.partitionBy(*self.keys).orderBy(F.col("_batch").desc())
        return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "_batch")


def run_stream(stream: DataFrame, name: str, mode: str = "append", keys: Sequence[str] = (),
               partition_by: Sequence[str] = (), path: str | None = None,
               checkpoint: str | None = None, trigger: dict | None = None,
               conf: dict | None = None) -> StreamRun:
    """Run ``stream`` until the available input is consumed, into parquet.

    ``conf`` holds session settings for this query only (a query captures the
    session conf when it starts; the previous values are restored after).
    """
    spark = stream.sparkSession
    base = scratch_path(spark, name)
    path = path or f"{base}/sink"
    checkpoint = checkpoint or f"{base}/checkpoint"
    w = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if mode == "append":
        w = w.format("parquet").option("path", path)
        if partition_by:
            w = w.partitionBy(*partition_by)
    else:
        def write_batch(batch: DataFrame, batch_id: int) -> None:
            (batch.withColumn("_batch", F.lit(batch_id).cast("bigint"))
             .write.mode("overwrite").parquet(f"{path}/_batch={batch_id}"))
        w = w.foreachBatch(write_batch)
    w = w.trigger(**(trigger or {"availableNow": True}))
    saved = {k: spark.conf.get(k, None) for k in (conf or {})}
    for k, v in (conf or {}).items():
        spark.conf.set(k, v)
    try:
        q = w.start()
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    q.awaitTermination()
    progress = q.recentProgress
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return StreamRun(spark, path, checkpoint, progress, mode, list(keys), str(q.runId))


def run_in_order(df: DataFrame, batch_col: str, build: Callable[[DataFrame], DataFrame], name: str, **kw) -> tuple[StreamRun, list[str]]:
    """Run the stream ``build(source)`` over ``df`` batch by batch: the rows of
    each value of ``batch_col`` arrive after those of smaller ones, in as many
    files as there are, and are one micro-batch. Order needs neither file names
    nor file times, as a batch is written when the one before has been taken.
    Returns the last run and the run ids, one a batch. NULL comes first."""
    spark = df.sparkSession
    base = scratch_path(spark, name)
    src, rest = f"{base}/source", df.drop(batch_col)
    kw = {"path": f"{base}/sink", "checkpoint": f"{base}/checkpoint", **kw}
    # without batches of its own the engine's watermark moves with the data alone
    kw["conf"] = {"spark.sql.streaming.noDataMicroBatches.enabled": "false", **kw.get("conf", {})}
    ids, run = [], None
    for value in sorted((r[0] for r in df.select(batch_col).distinct().collect()), key=lambda v: (v is not None, v)):   # bounded by the batches asked for
        df.where(F.col(batch_col).eqNullSafe(F.lit(value))).drop(batch_col).write.mode("append").parquet(src)
        run = run_stream(build(file_stream(spark, src, rest.schema)), name, **kw)
        ids.append(run.run_id)
    return run, ids


def emissions(stream: DataFrame, name: str, mode: str) -> DataFrame:
    """All rows that a query gives out in an output mode, with the ``_batch``
    that gave them."""
    spark, base = stream.sparkSession, scratch_path(stream.sparkSession, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/sink/_batch={batch_id}")

    q = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(StructType([*stream.schema.fields, StructField("_batch", LongType())])).parquet(f"{base}/sink")


def settled(rows: DataFrame, mode: str, keys: Sequence[str]) -> DataFrame:
    """The batch result that emitted rows come down to: all of them (append),
    the last of each key (update), those of the last batch (complete)."""
    if mode == "append":
        return rows.drop("_batch")
    if mode == "complete":
        return rows.where(F.col("_batch") == rows.agg(F.max("_batch")).scalar()).drop("_batch")
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("_batch").desc()))
    return rows.withColumn("_rn", last).where("_rn = 1").drop("_rn", "_batch")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)
