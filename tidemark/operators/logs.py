"""Monitoring queries over any log/event table (query history, job runs,
billing, access logs, lineage edges), parameterised by column names.

Each is one scan with hash aggregation (partial + final) or a window on a
bounded grain; top-k uses ``orderBy().limit()`` which Spark plans as a
per-partition top-k plus a final merge (TakeOrderedAndProject).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.literals import ts_lit


def slowest(df: DataFrame, duration: str, ts: str, lo, hi, k: int, text: str, preview: int,
            tiebreak: str) -> DataFrame:
    """Top-k slowest statements in ``[lo, hi)`` with a text preview."""
    return (df.where((F.col(ts) >= ts_lit(lo)) & (F.col(ts) < ts_lit(hi)))
            .withColumn("text_preview", F.left(F.col(text), F.lit(preview)))
            .orderBy(F.col(duration).desc(), F.col(tiebreak)).limit(k))


def exact_avg(c: Column) -> Column:
    """Mean of a 2-decimal amount via an exact decimal sum."""
    return F.sum(c.cast("decimal(12,2)")).cast("double") / F.count(c)


def expensive_repeats(df: DataFrame, text: str, duration: str, min_avg: float, min_count: int) -> DataFrame:
    """Statements run more than ``min_count`` times with a mean over ``min_avg``."""
    return (df.groupBy(text).agg(F.count(F.lit(1)).alias("n_runs"), exact_avg(F.col(duration)).alias("avg_duration"))
            .where((F.col("avg_duration") > min_avg) & (F.col("n_runs") > min_count)))


def resource_stats(df: DataFrame, resource: str, duration: str, slow: float) -> DataFrame:
    return df.groupBy(resource).agg(F.count(F.lit(1)).alias("n_queries"),
                                    exact_avg(F.col(duration)).alias("avg_duration"),
                                    F.count_if(F.col(duration) > slow).alias("n_slow"))


def failure_rate(df: DataFrame, job: str, failed: Column, min_rate: float) -> DataFrame:
    return (df.groupBy(job).agg(F.count(F.lit(1)).alias("n_runs"), F.count_if(failed).alias("n_failed"))
            .withColumn("failure_rate", F.col("n_failed").cast("double") / F.col("n_runs"))
            .where(F.col("failure_rate") > min_rate))


def failures_in_window(df: DataFrame, state: str, states: Sequence[str], ts: str, lo, hi) -> DataFrame:
    return df.where(F.col(state).isin(list(states)) & (F.col(ts) >= ts_lit(lo)) & (F.col(ts) < ts_lit(hi)))


def message_counts(df: DataFrame, message: str, where: Column | None = None) -> DataFrame:
    d = df.where(where) if where is not None else df
    return d.groupBy(message).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col(message))


def long_runs(df: DataFrame, job: str, order: Sequence[str], duration: str, factor: float,
              history: int = 10, bucket: Column | None = None) -> DataFrame:
    """Runs longer than ``factor`` x the mean of the job's previous ``history``
    runs. With ``bucket`` (e.g. the run's day) a job with a huge history is
    split by bucket (see ``windows.prior_rows``)."""
    from tidemark.operators.windows import prior_rows
    d = df.withColumn("_d", F.col(duration).cast("decimal(12,2)"))
    s = prior_rows(d, [job], order, "_d", history, bucket=bucket)
    s = s.withColumn("avg_prev", F.col("_prior_sum").cast("double") / F.col("_prior_cnt")) \
        .drop("_d", "_prior_sum", "_prior_cnt")
    return s.where(F.col(duration) > F.lit(factor) * F.col("avg_prev"))


def access_pattern(df: DataFrame, user: str, obj: str, ts: str, since) -> DataFrame:
    return (df.where(F.col(ts) >= ts_lit(since)).groupBy(user, obj)
            .agg(F.count(F.lit(1)).alias("access_count"), F.max(ts).alias("last_access")))


def costs(df: DataFrame, day_ts: str, keys: Sequence[str], amount: str) -> DataFrame:
    return (df.groupBy(F.to_date(day_ts).alias("usage_date"), *keys)
            .agg(F.sum(F.col(amount).cast("decimal(12,2)")).cast("double").alias("total_cost"),
                 F.count(F.lit(1)).alias("n_records")))


def idle_resources(df: DataFrame, resource: str, ts: str, max_hours: int) -> DataFrame:
    """Resources active (first to last record of a day) more than ``max_hours``."""
    d = (df.groupBy(resource, F.to_date(ts).alias("day"))
         .agg(F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen")))
    return (d.withColumn("hours_up", F.expr("timestampdiff(HOUR, first_seen, last_seen)"))
            .where(F.col("hours_up") > max_hours))


def flow_metrics(df: DataFrame, step: str, ts: str, user: str, amount: str) -> DataFrame:
    return (df.groupBy(step, F.to_date(ts).alias("day"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(user).alias("n_users"),
                 F.sum(F.col(amount).cast("decimal(12,2)")).cast("double").alias("total_amount")))


def history_timeouts(df: DataFrame, job: str, duration_sec: Column, ok: Column,
                     default_sec: float = 3600.0, factor: float = 3.0) -> DataFrame:
    """Per job: max(default, factor x mean duration of successful runs)."""
    return (df.where(ok).groupBy(job)
            .agg((F.sum(duration_sec).cast("double") / F.count(F.lit(1))).alias("avg_success_sec"))
            .withColumn("timeout_sec", F.greatest(F.lit(default_sec), F.lit(factor) * F.col("avg_success_sec"))))


def direct_lineage(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Per node: distinct direct upstream and downstream neighbours."""
    up = edges.groupBy(F.col(dst).alias("node")).agg(F.count_distinct(src).alias("n_upstream"))
    down = edges.groupBy(F.col(src).alias("node")).agg(F.count_distinct(dst).alias("n_downstream"))
    return (up.join(down, "node", "full_outer")
            .select("node", F.coalesce("n_upstream", F.lit(0)).alias("n_upstream"),
                    F.coalesce("n_downstream", F.lit(0)).alias("n_downstream")))
