"""Streaming operators: event-time windows, sessions, stream-stream interval
joins and late-row side outputs (custom keyed state: ``spells``).

All work on batch DataFrames too, so the same function is the batch and the
stream definition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def windowed(df: DataFrame, ts: str, length: str, slide: str | None = None, keys: Sequence[str] = (),
             aggs: Sequence[Column] = (), watermark: str | None = None) -> DataFrame:
    """Tumbling (no ``slide``) or sliding event-time windows per key, with the
    bounds as two NTZ columns ``window_start``/``window_end``."""
    if watermark:
        df = df.withWatermark(ts, watermark)
    win = F.window(ts, length, slide) if slide else F.window(ts, length)
    return (df.groupBy(win.alias("w"), *keys).agg(*aggs)
            .withColumns({"window_start": F.col("w.start").cast("timestamp_ntz"),
                          "window_end": F.col("w.end").cast("timestamp_ntz")}).drop("w"))


def sessions(df: DataFrame, ts: str, gap: str, keys: Sequence[str], aggs: Sequence[Column] = (),
             watermark: str | None = None) -> DataFrame:
    """Session windows: a session ends after ``gap`` without events."""
    if watermark:
        df = df.withWatermark(ts, watermark)
    return (df.groupBy(F.session_window(ts, gap).alias("s"), *keys).agg(*aggs)
            .withColumns({"session_start": F.col("s.start").cast("timestamp_ntz"),
                          "session_end": F.col("s.end").cast("timestamp_ntz")}).drop("s"))


def late_rows(df: DataFrame, event_ts: str, arrival_ts: str, max_delay: str) -> tuple[DataFrame, DataFrame]:
    """Split into (on_time, late): late when arrival - event time > max_delay."""
    late = F.col(arrival_ts) > F.col(event_ts) + F.expr(f"INTERVAL {max_delay}")
    return df.where(~late), df.where(late)


def deduplicated(df: DataFrame, keys: Sequence[str], ts: str, watermark: str) -> DataFrame:
    """The first row of each key within the watermark's delay; rows behind the watermark are dropped, one by one."""
    return df.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(list(keys))


def late_drop_report(progress: DataFrame, kept: DataFrame, late: DataFrame, batch_col: str, run_ids: Sequence[str]) -> DataFrame:
    """``<batch_col>, input_rows, dropped_rows, kept_rows, late_rows`` of each batch
    of a stream without aggregation before the watermark. ``progress`` has a
    run per batch in the order of ``run_ids``; ``kept`` are the rows of the sink
    and ``late`` those that arrived late, with their batch. What the engine says
    it took in and dropped has to come to what the sink holds: the job fails
    where kept + dropped is not the input."""
    sums = progress.groupBy("run_id").agg(F.sum("input_rows").alias("input_rows"), F.sum("dropped_rows").alias("dropped_rows"))
    kept, late = (x.groupBy(batch_col).agg(F.count(F.lit(1)).alias(n)) for x, n in ((kept, "kept_rows"), (late, "late_rows")))
    spark = progress.sparkSession
    # bounded: a row a run; the batches came in the order of their numbers
    runs = spark.createDataFrame(list(enumerate(run_ids)), "at int, run_id string").join(sums, "run_id", "left")
    order = kept.select(batch_col).union(late.select(batch_col)).distinct().select(batch_col, (F.row_number().over(Window.orderBy(batch_col)) - 1).alias("at"))
    out = runs.join(order, "at").join(kept, batch_col, "left").join(late, batch_col, "left").fillna(0, ["kept_rows", "late_rows", "input_rows", "dropped_rows"])
    whole = F.col("kept_rows") + F.col("dropped_rows") == F.col("input_rows")
    return out.withColumn("kept_rows", F.when(whole, F.col("kept_rows")).otherwise(F.raise_error(F.lit("kept and dropped rows are not the input")).cast("long"))) \
        .select(batch_col, "input_rows", "dropped_rows", "kept_rows", "late_rows")


def interval_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                  lower: str, upper: str, how: str = "inner",
                  left_watermark: str | None = None, right_watermark: str | None = None) -> DataFrame:
    """``left.key = right.key AND right_ts + lower <= left_ts <= right_ts + upper``.

    With watermarks on both sides the state of each side is bounded by the
    interval, and for ``leftOuter`` unmatched left rows are emitted once the
    watermark passes their interval.
    """
    if left_watermark:
        left = left.withWatermark(left_ts, left_watermark)
    if right_watermark:
        right = right.withWatermark(right_ts, right_watermark)
    l, r = left.alias("l"), right.alias("r")
    cond = ((F.col(f"l.{key}") == F.col(f"r.{key}"))
            & (F.col(f"l.{left_ts}") >= F.col(f"r.{right_ts}") + F.expr(f"INTERVAL {lower}"))
            & (F.col(f"l.{left_ts}") <= F.col(f"r.{right_ts}") + F.expr(f"INTERVAL {upper}")))
    return l.join(r, cond, how)


def features(df: DataFrame, ts: str, amount: str) -> DataFrame:
    """Hour of day, day of week and amount band (same code for batch and stream)."""
    return df.withColumns({
        "hour_of_day": F.hour(ts), "day_of_week": F.dayofweek(ts),
        "amount_category": F.when(F.col(amount) < 10, "small").when(F.col(amount) < 100, "medium")
        .otherwise("large")})
