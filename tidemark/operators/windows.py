"""Window operators.

Partitioned windows run one group per task, so they are used on grains whose
group size is bounded (days, periods) or with a running frame (streamed, not
materialised). A *global* ranking is not a one-partition window here: it is
computed with range partitioning and per-partition offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where NULL equals NULL; the keys stay once, from the
    left. Grouped and windowed results treat NULL as a key of its own, so a
    plain join of such a result back to its rows would lose that group."""
    names = {c: f"_on_{c}" for c in on}
    cond = None
    for c, r in names.items():
        eq = F.col(c).eqNullSafe(F.col(r))
        cond = eq if cond is None else cond & eq
    return left.join(right.withColumnsRenamed(names), cond, how).drop(*names.values())


def top_n_per_group(df: DataFrame, by: Sequence[str], order_by: Sequence[Column], n: int) -> DataFrame:
    """``row_number() <= n``; Spark adds a partial WindowGroupLimit before the
    shuffle, so each map task sends at most ``n`` rows per group."""
    w = Window.partitionBy(*by).orderBy(*order_by)
    return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)


def lag_change(df: DataFrame, by: Sequence[str], order_by: Sequence[str], cols: Sequence[str],
               ratio: bool = False) -> DataFrame:
    """Add ``prev_<c>`` and ``<c>_change`` (or a ratio) for each measure."""
    w = Window.partitionBy(*by).orderBy(*order_by)
    out = df.withColumns({f"prev_{c}": F.lag(c).over(w) for c in cols})
    if ratio:
        return out.withColumns({f"{c}_change": F.try_divide(F.col(c) - F.col(f"prev_{c}"), F.col(f"prev_{c}"))
                                for c in cols})
    return out.withColumns({f"{c}_change": F.col(c) - F.col(f"prev_{c}") for c in cols})


def _bucket_offsets(df: DataFrame, by: Sequence[str], measure: Column) -> DataFrame:
    """Per (key, bucket): the total of ``measure`` over all earlier buckets of
    the key, NULL if none of them has a value. The window runs over the bucket
    summary (keys x buckets rows)."""
    totals = df.groupBy(*by, "_bk").agg(measure.alias("_bt"))
    w = Window.partitionBy(*by).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*by, "_bk", F.sum("_bt").over(w).alias("_off"))


def running_sum(df: DataFrame, by: Sequence[str], order_by: Sequence[str], col: str, out: str,
                rows: bool = False, bucket: Column | None = None) -> DataFrame:
    """Running total. Default RANGE frame: rows tied on the order share a
    value; ``rows=True``: a strict row-by-row running sum.

    With ``bucket`` (a time bucket coarser than the order key, e.g. the week
    of a day) the sum is computed within (key, bucket) partitions plus the
    total of the key's earlier buckets, so a key holding a third of the rows
    is spread over its buckets instead of one task.
    """
    if bucket is None:
        w = Window.partitionBy(*by).orderBy(*order_by)
        if rows:
            w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(out, F.sum(col).over(w))
    b = df.withColumn("_bk", bucket)
    w = Window.partitionBy(*by, "_bk").orderBy(*order_by)
    if rows:
        w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = b.withColumn("_in", F.sum(col).over(w))
    offs = _bucket_offsets(b, by, F.sum(col))
    # a bucket whose values so far are all NULL carries the earlier total on
    total = F.coalesce(F.col("_in") + F.col("_off"), "_in", "_off")
    return join_null_safe(within, offs, [*by, "_bk"], "left").withColumn(out, total).drop("_bk", "_in", "_off")


def row_numbers(df: DataFrame, by: Sequence[str], order_by: Sequence, out: str,
                bucket: Column | None = None) -> DataFrame:
    """``row_number()`` per key; with ``bucket`` (coarser than the order, e.g.
    the day of a timestamp) computed per (key, bucket) plus the row count of
    the key's earlier buckets."""
    if bucket is None:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy(*order_by)).cast("bigint"))
    b = df.withColumn("_bk", bucket)
    within = b.withColumn("_in", F.row_number().over(Window.partitionBy(*by, "_bk").orderBy(*order_by)))
    offs = _bucket_offsets(b, by, F.count(F.lit(1)))
    return (join_null_safe(within, offs, [*by, "_bk"], "left")
            .withColumn(out, (F.col("_in") + F.coalesce("_off", F.lit(0))).cast("bigint")).drop("_bk", "_in", "_off"))


def prior_rows(df: DataFrame, by: Sequence[str], order_cols: Sequence[str], value: str, n: int,
               bucket: Column | None = None) -> DataFrame:
    """Sum and count of ``value`` over each row's previous ``n`` rows of its
    key (``ROWS BETWEEN n PRECEDING AND 1 PRECEDING``), as ``_prior_sum`` and
    ``_prior_cnt``.

    With ``bucket`` (a time bucket, monotone in the order) the window runs per
    (key, bucket), and each bucket also receives, as halo rows, the last ``n``
    rows before it: the per-bucket tails (top ``n`` rows, limited before the
    shuffle) copied to the later buckets whose frames reach them. A tail row
    reaches at most ``n`` later buckets, so the halo is bounded by n*n rows
    per bucket whatever the key's size, and the result is exact.
    """
    order = [F.col(c) for c in order_cols]
    if bucket is None:
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(-n, -1)
        return df.withColumns({"_prior_sum": F.sum(value).over(w), "_prior_cnt": F.count(value).over(w)})
    b = df.withColumn("_bk", bucket)
    wk = Window.partitionBy(*by).orderBy("_bk")
    summ = (b.groupBy(*by, "_bk").agg(F.count(F.lit(1)).alias("_bcnt"))
            .select(*by, "_bk", "_bcnt", F.row_number().over(wk).alias("_i"),
                    F.coalesce(F.sum("_bcnt").over(wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                    .alias("_before")))                       # rows of the key before bucket _i
    wd = Window.partitionBy(*by, "_bk").orderBy(*[F.col(c).desc() for c in order_cols])
    tails = join_null_safe(b.withColumn("_r", F.row_number().over(wd)).where(F.col("_r") <= n), summ, [*by, "_bk"])
    # rows strictly between a tail row and the start of bucket j:
    # (_r - 1) + before(j) - (before(i) + count(i)); it belongs to j's halo while that is < n
    halo = (join_null_safe(
        tails.withColumn("_j", F.explode(F.sequence(F.col("_i") + 1, F.col("_i") + n - F.col("_r") + 1))),
        summ.select(*by, F.col("_i").alias("_j"), F.col("_before").alias("_before_j"), F.col("_bk").alias("_bj")), [*by, "_j"])
            .where(F.col("_r") - 1 + F.col("_before_j") - F.col("_before") - F.col("_bcnt") < n)
            .select(*df.columns, F.col("_bj").alias("_bk"), F.lit(1).alias("_h")))
    u = b.select(*df.columns, "_bk", F.lit(0).alias("_h")).unionByName(halo)
    w = Window.partitionBy(*by, "_bk").orderBy(*order).rowsBetween(-n, -1)
    return (u.withColumns({"_prior_sum": F.sum(value).over(w), "_prior_cnt": F.count(value).over(w)})
            .where(F.col("_h") == 0).drop("_bk", "_h"))


def moving_avg(df: DataFrame, by: Sequence[str], order_by: Sequence[str], col: str, out: str,
               preceding: int, exclude_current: bool = False) -> DataFrame:
    """Average over the ``preceding`` rows before (and, unless excluded, the
    current row). ``ROWS 6 PRECEDING`` = 7 rows, not 7 days."""
    hi = -1 if exclude_current else 0
    w = Window.partitionBy(*by).orderBy(*order_by).rowsBetween(-preceding, hi)
    return df.withColumn(out, F.avg(col).over(w))


def _range_parts(df: DataFrame, by: Sequence[str], key: Column, partitions) -> DataFrame:
    """Range-partition by (group, value) and record each row's partition id.

    The range bounds come from sampling the input; when the input arrives
    through a shuffle its row order, hence the sample, can differ between two
    evaluations. The ids are therefore fixed once: the partitioned rows are
    written with their ``_pid`` as a parquet table in the shared checkpoint
    folder, and every later branch reads the same ids.
    """
    from tidemark.session import materialize
    n = partitions or df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    parted = (df.repartitionByRange(int(n), *[F.col(c) for c in by], key)
              .withColumn("_pid", F.spark_partition_id()))
    return materialize(parted, "range-parts")


def _part_offsets(per: DataFrame, by: Sequence[str], measure: str) -> DataFrame:
    """Prefix sums of a per-(group, partition) measure over earlier partitions
    of the group (a window over groups x partitions rows)."""
    w = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return per.select(*by, "_pid", F.coalesce(F.sum(measure).over(w), F.lit(0)).alias("_off"))


def global_rank(df: DataFrame, col: str, descending: bool = True, dense: bool = False,
                out: str = "rank", partitions: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """RANK / DENSE_RANK over the whole table (or within ``by`` groups)
    without a single-task window, even for a group holding most rows.

    1. reduce the rows to (group, value, count), so a value that holds very
       many rows is one row from here on;
    2. range-partition these by (group, value) and number the partitions
       (fixed once, see ``_range_parts``; only the reduced rows are written);
    3. a prefix sum over the rows (or values) per (group, partition) gives each
       partition's offset (a window over groups x partitions rows);
    4. rank inside each (group, partition) + its offset, joined back to the
       rows by group and value (NULL-safe; the planner can split a hot value).

    NULL groups form a group, NULL values rank as the sort order places them.
    """
    by = list(by)
    key = F.col(col).desc() if descending else F.col(col).asc()
    counts = df.groupBy(*by, col).agg(F.count(F.lit(1)).alias("_c"))
    parted = _range_parts(counts, by, key, partitions)
    offs = _part_offsets(parted.groupBy(*by, "_pid").agg((F.count(F.lit(1)) if dense else F.sum("_c")).alias("_cnt")), by, "_cnt")
    local = Window.partitionBy(*by, "_pid").orderBy(key)
    before = F.row_number().over(local) - 1 if dense else F.coalesce(
        F.sum("_c").over(local.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = join_null_safe(parted.withColumn("_lr", before), offs, [*by, "_pid"])
    ranks = ranked.select(*by, col, (F.col("_lr") + F.col("_off") + 1).cast("int").alias("_rank"))
    return join_null_safe(df, ranks, [*by, col]).withColumn(out, F.col("_rank")).drop("_rank")
