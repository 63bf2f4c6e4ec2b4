"""Aggregation operators.

All are hash aggregations with a partial (map-side) phase, so a hot group is
combined before the shuffle. Exact percentiles are computed from value counts
and range-partitioned cumulative counts instead of collecting a group's values
into one buffer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact_mean(c, out: str) -> Column:
    """Mean as DOUBLE(sum)/count: with an exact (decimal/integer) sum this is
    bit-identical across engines and partitionings."""
    col = F.col(c) if isinstance(c, str) else c
    return (F.sum(col).cast("double") / F.count(col)).alias(out)


def conditional_counts(df: DataFrame, by: Sequence[str], conds: Mapping[str, str | Column]) -> DataFrame:
    """``count_if`` per named predicate, one pass."""
    return df.groupBy(*by).agg(*[
        F.count_if(F.expr(p) if isinstance(p, str) else p).alias(n) for n, p in conds.items()])


def exact_percentiles(df: DataFrame, value: str, by: Sequence[str], ps: Mapping[str, float],
                      partitions: int | None = None) -> DataFrame:
    """PERCENTILE_CONT for each ``name -> p`` per group, exactly.

    Rows are first reduced to (group, value, count) -- a partial aggregate.
    Cumulative counts come from range partitioning by (group, value) plus
    per-partition offsets (as in ``windows.global_rank``), so a group with
    many distinct values is spread over several tasks; the two values around
    position ``(n-1)*p`` are then interpolated.
    """
    from tidemark.operators.windows import _part_offsets, _range_parts, join_null_safe
    out_by = list(by)
    if not out_by:                       # one global group
        df, by = df.withColumn("_g", F.lit(0)), ["_g"]
    by = list(by)
    counts = (df.where(F.col(value).isNotNull())
              .groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c")))
    parted = _range_parts(counts, by, F.col(value).asc(), partitions)
    offs = _part_offsets(parted.groupBy(*by, "_pid").agg(F.sum("_c").alias("_pc")), by, "_pc")
    w = Window.partitionBy(*by, "_pid").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    totals = counts.groupBy(*by).agg(F.sum("_c").alias("_n"))
    pos = (join_null_safe(parted.withColumn("_cum", F.sum("_c").over(w)), offs, [*by, "_pid"])
           .withColumn("_hi", F.col("_cum") + F.col("_off") - 1)       # last 0-based position
           .withColumn("_lo", F.col("_hi") - F.col("_c") + 1))
    pos = join_null_safe(pos, totals, by)
    aggs = []
    for name, p in ps.items():
        r = (F.col("_n") - 1) * F.lit(float(p))
        fl, ce = F.floor(r), F.ceil(r)
        aggs += [
            F.max(F.when((F.col("_lo") <= fl) & (fl <= F.col("_hi")), F.col(value))).alias(f"_f_{name}"),
            F.max(F.when((F.col("_lo") <= ce) & (ce <= F.col("_hi")), F.col(value))).alias(f"_c_{name}"),
            F.max(r - fl).alias(f"_r_{name}"),
        ]
    res = pos.groupBy(*by).agg(*aggs)
    return res.select(*out_by, *[
        (F.col(f"_f_{n}") + (F.col(f"_c_{n}") - F.col(f"_f_{n}")) * F.col(f"_r_{n}")).alias(n)
        for n in ps])


def profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """count / mean / stddev / min / max for numeric columns, one row per
    column (a single scan, unpivoted with ``stack``)."""
    if cols is None:
        cols = [f.name for f in df.schema.fields
                if f.dataType.typeName() in ("integer", "long", "double", "float", "decimal", "short")]
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(c).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    parts = ", ".join(f"'{c}', n{i}, m{i}, s{i}, lo{i}, hi{i}" for i, c in enumerate(cols))
    return wide.selectExpr(
        f"stack({len(cols)}, {parts}) AS (column_name, count, mean, stddev, min, max)")


def metrics_long(df: DataFrame, metrics: Mapping[str, Column]) -> DataFrame:
    """Several scalar metrics from one scan, as (metric, value) rows."""
    wide = df.agg(*[c.cast("double").alias(f"_m{i}") for i, c in enumerate(metrics.values())])
    parts = ", ".join(f"'{n}', _m{i}" for i, n in enumerate(metrics))
    return wide.selectExpr(f"stack({len(metrics)}, {parts}) AS (metric, value)")


def duplicate_ratio(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Total rows, distinct rows over ``cols`` and the duplicate share.

    The distinct count is an aggregate over a distinct projection (two hash
    aggregations, both partial), not a second ``count()`` job.
    """
    d = df.select(*cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
    return d.agg(F.sum("_c").alias("total_rows"), F.count(F.lit(1)).alias("distinct_rows")) \
        .withColumn("duplicate_ratio",
                    F.lit(1.0) - F.try_divide(F.col("distinct_rows").cast("double"), F.col("total_rows")))
