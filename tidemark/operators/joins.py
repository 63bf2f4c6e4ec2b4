"""Join operators Spark has no single primitive for, written as plain
DataFrame plans: a bucketed range join, a point-in-time (as-of) lookup,
compare-by-key (full outer with null-safe equality), insert-only anti-join,
a join with one-row statistics (scalar subqueries, not a cross join) and
reachability over an edge list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import broadcast_if_small, materialize


def lookup_join(fact: DataFrame, dim: DataFrame, on, how: str = "inner",
                limit_bytes: int | None = None) -> DataFrame:
    """Join a fact to a dimension, broadcasting the dimension only when its
    estimated size is under the limit (else a shuffle join, chosen by AQE)."""
    d = broadcast_if_small(dim) if limit_bytes is None else broadcast_if_small(dim, limit_bytes)
    return fact.join(d, on=on, how=how)


def range_join(facts: DataFrame, ranges: DataFrame, value: str, start: str, end: str,
               unit: str = "month") -> DataFrame:
    """``facts.value BETWEEN ranges.start AND ranges.end`` without a nested loop.

    Each range is exploded into the calendar buckets (``unit``: month or day)
    it overlaps; facts get one bucket. The join is then an equi-join on the
    bucket (hash-partitioned, no cartesian product) followed by the exact
    range filter. A range spanning k buckets is copied k times, so choose a
    unit near the typical range length. A range with a NULL end, or that ends
    before it starts, matches nothing.
    """
    step = F.expr(f"INTERVAL 1 {unit.upper()}")
    r = ranges.where(F.col(start) <= F.col(end)).withColumn(
        "_bucket", F.explode(F.sequence(F.date_trunc(unit, F.col(start)).cast("date"),
                                        F.date_trunc(unit, F.col(end)).cast("date"), step)))
    f = facts.withColumn("_bucket", F.date_trunc(unit, F.col(value)).cast("date"))
    return (f.join(r, on="_bucket")
            .where(F.col(value).between(F.col(start), F.col(end)))
            .drop("_bucket"))


def asof_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_ts: str, right_ts: str,
              values: Sequence[str], tiebreak: str | None = None, bucket: str | None = "day") -> DataFrame:
    """For each left row, the ``values`` of the latest right row with the same
    key and ``right_ts <= left_ts`` (NULLs when there is none).

    Two levels, so a key holding a third of all rows is not one task:

    1. left and right rows are unioned and partitioned by (key, time bucket);
       within a bucket the newest right row is carried forward in time order
       (right before left on equal times);
    2. left rows with no right row earlier in their own bucket take the newest
       right row of the closest earlier bucket, found on a per-(key, bucket)
       summary whose size is bounded by keys x buckets, not by the data.

    ``bucket=None`` partitions by key only (one level).
    """
    on = list(on)
    vals = list(values)
    lcols = left.columns
    for k in on:                       # NULL keys never match, as in an equality join
        right = right.where(F.col(k).isNotNull())
    order = ["_t", "_side"] + (["_tb"] if tiebreak else [])
    rstruct = F.struct(*[F.col(v) for v in vals])
    tb_type = right.schema[tiebreak].dataType if tiebreak else None
    bkt = (lambda c: F.date_trunc(bucket, F.col(c))) if bucket else (lambda c: F.lit(0))
    l2 = left.select(*[F.col(c) for c in lcols], F.col(left_ts).alias("_t"), F.lit(1).alias("_side"),
                     bkt(left_ts).alias("_b"), F.lit(None).cast(rstruct_type(right, vals)).alias("_v"),
                     *([F.lit(None).cast(tb_type).alias("_tb")] if tiebreak else []))
    r2 = right.select(*[F.col(k) for k in on],
                      *[F.lit(None).cast(left.schema[c].dataType).alias(c) for c in lcols if c not in on],
                      F.col(right_ts).alias("_t"), F.lit(0).alias("_side"), bkt(right_ts).alias("_b"),
                      rstruct.alias("_v"), *([F.col(tiebreak).alias("_tb")] if tiebreak else []))
    w = (Window.partitionBy(*on, "_b").orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    first = (l2.unionByName(r2)
             .select(*[F.col(c) for c in lcols], "_side", "_b", F.last("_v", ignorenulls=True).over(w).alias("_v"))
             .where(F.col("_side") == 1).drop("_side"))
    if not bucket:
        return first.select(*lcols, *[F.col(f"_v.{v}").alias(v) for v in vals])
    # level 2: newest right row per (key, bucket), carried across buckets
    last_in_bucket = (right.groupBy(*[F.col(k) for k in on], bkt(right_ts).alias("_b"))
                      .agg(F.max_by(rstruct, F.struct(F.col(right_ts), *([F.col(tiebreak)] if tiebreak else [])))
                           .alias("_rv")))
    need = first.where(F.col("_v").isNull()).select(*on, "_b").distinct()
    summary = (need.select(*on, "_b", F.lit(1).alias("_s"), F.lit(None).cast(rstruct_type(right, vals)).alias("_rv"))
               .unionByName(last_in_bucket.select(*on, "_b", F.lit(0).alias("_s"), "_rv")))
    w2 = Window.partitionBy(*on).orderBy("_b", F.col("_s").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = (summary.withColumn("_prev", F.last("_rv", ignorenulls=True).over(w2))
               .where(F.col("_s") == 1).select(*on, "_b", "_prev"))
    out = first.join(carried, on=[*on, "_b"], how="left")
    v = F.coalesce(F.col("_v"), F.col("_prev"))
    return out.select(*lcols, *[v.getField(x).alias(x) for x in vals])


def rstruct_type(df: DataFrame, cols: Sequence[str]):
    from pyspark.sql.types import StructField, StructType
    return StructType([StructField(c, df.schema[c].dataType, True) for c in cols])


def compare_by_key(before: DataFrame, after: DataFrame, keys: Sequence[str],
                   cols: Sequence[str] | None = None) -> DataFrame:
    """Full outer join of two versions on ``keys``; ``_diff`` is insert,
    delete, update or same (values compared null-safely)."""
    keys = list(keys)
    cols = list(cols or [c for c in before.columns if c not in keys])
    b = before.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in cols], F.lit(True).alias("_in_b"))
    a = after.select(*keys, *[F.col(c).alias(f"_a_{c}") for c in cols], F.lit(True).alias("_in_a"))
    j = b.join(a, on=keys, how="full_outer")
    same = F.lit(True)
    for c in cols:
        same = same & F.col(f"_b_{c}").eqNullSafe(F.col(f"_a_{c}"))
    diff = (F.when(F.col("_in_b").isNull(), "insert")
            .when(F.col("_in_a").isNull(), "delete")
            .when(same, "same").otherwise("update"))
    return j.withColumn("_diff", diff)


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str],
                order_by: Sequence | None = None) -> DataFrame:
    """Rows of ``source`` whose key is not in ``target`` (one per key), appended
    to ``target``: the insert-only merge."""
    keys = list(keys)
    src = source
    if order_by is not None:
        w = Window.partitionBy(*keys).orderBy(*order_by)
        src = src.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    else:
        src = src.dropDuplicates(keys)
    new = src.join(target.select(*keys), on=keys, how="left_anti")
    return target.unionByName(new.select(*target.columns))


def with_global_stats(df: DataFrame, stats: dict[str, Column]) -> DataFrame:
    """Attach one-row global statistics to every row.

    Each statistic is a scalar subquery (computed once, inlined as a literal
    by the planner), so there is neither a cross join nor a global window.
    """
    return df.withColumns({name: df.agg(expr).scalar() for name, expr in stats.items()})


def reachable(edges: DataFrame, root: int, max_level: int = 5, src: str = "src", dst: str = "dst") -> DataFrame:
    """``node, min_level, n_paths``: nodes reachable from ``root`` within
    ``max_level`` hops, the smallest level and the number of paths.

    Level by level: the paths to a level's nodes are counted, not listed
    (``node -> n_paths``), so a level is never larger than the nodes, however
    many paths lead to them; the number of rows has no limit, and the walk ends
    with the first level without nodes. Each level is written to the shared
    folder, so plans stay short. The level cap bounds the work on cycles. Edges
    that repeat are paths of their own; NULL ends lead nowhere.
    """
    e = edges.select(F.col(src).cast("bigint").alias("_from"), F.col(dst).cast("bigint").alias("node")).where("_from IS NOT NULL AND node IS NOT NULL")
    level = e.where(F.col("_from") == root).groupBy("node").agg(F.count(F.lit(1)).alias("n_paths"))
    found = []
    for k in range(1, max_level + 1):
        level = materialize(level, "reachable")
        if level.isEmpty():
            break
        found.append(level.withColumn("level", F.lit(k)))
        level = e.join(level.withColumnRenamed("node", "_from"), "_from").groupBy("node").agg(F.sum("n_paths").alias("n_paths"))
    if not found:
        found = [level.withColumn("level", F.lit(0))]
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out.groupBy("node").agg(F.min("level").alias("min_level"), F.sum("n_paths").alias("n_paths"))
