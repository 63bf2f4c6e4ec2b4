"""Registered Structured Streaming queries (X, J-15..J-17, C-12, G-11, M-05,
S-09) with oracle SQL.

Every query stages what Spark derives from the driver tables as time-ordered
files in a fresh folder, runs a checkpointed stream over them with
``availableNow`` and reads the sink back as a batch DataFrame. Windowed and
keyed aggregations run in update mode with a watermark (bounded state) into an
idempotent per-batch sink; session windows, for which Spark has no update
mode, run in append mode. The watermarked queries take one staged part per
trigger, so they run in several batches at every size; a part is as many files
as its bytes make.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import changes as ch
from tidemark.operators import ml
from tidemark.operators import quality as q
from tidemark.operators.layout import dir_bytes
from tidemark.operators.privacy import mask_pii
from tidemark.plans.changes_quality import EVENT_RULES, cdc_source, versioned_feed
from tidemark.plans.io_layout import MSG_SCHEMA, to_messages
from tidemark.plans.ml_udf import LINE_FEATURES, SCORE_SQL, line_features
from tidemark.plans.privacy_logs import _mask_sql
from tidemark.session import input_bytes, scratch_path
from tidemark.sources import files as fs
from tidemark.sources.tables import tables
from tidemark.streaming import operators as so
from tidemark.streaming import runner as sr
from tidemark.streaming.progress import ProgressLog
from tidemark.streaming.spells import ROCKSDB, activity_spells, spell_buckets
from tidemark.streaming.upsert import KeyedSnapshot, buckets_for, upsert_stream

QUERIES: dict = {}
SQL: dict = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def T(spark, d):
    return tables(spark, d)


def dec(c):
    return F.col(c).cast("decimal(12,2)")


BATCHES = 6                      # parts of one batch each that the watermarked queries read


def _event_stream(spark, d, name, n_files=8, max_files=None, flush=None):
    events = T(spark, d).events
    if flush:
        events = sr.with_flush_row(events, "ts", flush)
    return _staged(spark, events, name, n_files, "ts", max_files)


def _staged(spark, df, name, n_parts, order_by, max_parts=None):
    """A stream of ``df`` in ``n_parts`` parts by ``order_by``, ``max_parts`` a batch; a part is as many files as its bytes make."""
    each = sr.files_each(df, n_parts)
    path, schema = sr.stage_files(df, f"{name}-src", n_parts * each, order_by)
    return sr.file_stream(spark, path, schema, max_files=max_parts and max_parts * each)


def _timed(stream):
    return sr.event_time(stream, "ts")


# ====================================================================== windows

@register("stream_tumbling", """
SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS window_start, time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE AS window_end,
       event_type, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total, count(*) AS n
FROM events GROUP BY ALL""")
def q_stream_tumbling(spark, d):
    s = _timed(_event_stream(spark, d, "tumbling", BATCHES, 1))
    agg = so.windowed(s, "ts", "10 minutes", keys=["event_type"], watermark="1 hour",
                      aggs=[F.sum(dec("value")).alias("total"), F.count(F.lit(1)).alias("n")])
    out = sr.run_stream(agg, "tumbling", "update", keys=["window_start", "event_type"]).result()
    return out.withColumn("total", F.col("total").cast("double"))


@register("stream_sliding", """
WITH x AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS b, event_type, value FROM events),
w AS (SELECT b AS window_start, event_type, value FROM x
      UNION ALL SELECT b - INTERVAL 5 MINUTE, event_type, value FROM x)
SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, event_type,
       CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total, count(*) AS n
FROM w GROUP BY ALL""")
def q_stream_sliding(spark, d):
    s = _timed(_event_stream(spark, d, "sliding", BATCHES, 1))
    agg = so.windowed(s, "ts", "10 minutes", "5 minutes", keys=["event_type"], watermark="1 hour",
                      aggs=[F.sum(dec("value")).alias("total"), F.count(F.lit(1)).alias("n")])
    out = sr.run_stream(agg, "sliding", "update", keys=["window_start", "event_type"]).result()
    return out.withColumn("total", F.col("total").cast("double"))


@register("stream_session", """
WITH f AS (SELECT user_id, ts, value,
                  CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                         OR ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 5 MINUTE THEN 1 ELSE 0 END AS new_s
           FROM events),
g AS (SELECT *, sum(new_s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM f)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 5 MINUTE AS session_end, count(*) AS n_events,
       CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total
FROM g GROUP BY user_id, sid""")
def q_stream_session(spark, d):
    # append mode: a session is written once, when the watermark has passed its
    # end, and leaves the state; the flush row closes the last sessions
    s = _timed(_event_stream(spark, d, "session", BATCHES, 1, flush={"user_id": [-1]}))
    agg = so.sessions(s, "ts", "5 minutes", ["user_id"],
                      [F.count(F.lit(1)).alias("n_events"), F.sum(dec("value")).alias("total")], watermark="10 minutes")
    out = sr.run_stream(agg, "session", "append").result().where("user_id >= 0")
    return out.withColumn("total", F.col("total").cast("double"))


@register("stream_hourly", """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       event_type, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total,
       CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / count(value) AS avg_value, count(*) AS n, max(ts) AS last_ts
FROM events GROUP BY ALL""")
def q_stream_hourly(spark, d):
    s = _event_stream(spark, d, "hourly", BATCHES, 1).withColumn("ts_ntz", F.col("ts")).transform(_timed)
    agg = so.windowed(s, "ts", "1 hour", keys=["event_type"], watermark="2 hours",
                      aggs=[F.sum(dec("value")).alias("_sum"), F.count("value").alias("_cnt"),
                            F.count(F.lit(1)).alias("n"), F.max("ts_ntz").alias("last_ts")])
    out = sr.run_stream(agg, "hourly", "update", keys=["window_start", "event_type"]).result()
    return out.select("window_start", "window_end", "event_type", F.col("_sum").cast("double").alias("total"),
                      (F.col("_sum").cast("double") / F.col("_cnt")).alias("avg_value"), "n", "last_ts")


# ====================================================================== rows / state

@register("late_rows", """
SELECT event_id, user_id, ts, ts + CAST(json_extract_string(props, '$.k') AS INTEGER) * 2 * INTERVAL 1 MINUTE AS arrival_ts
FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) * 2 > 60""")
def q_late_rows(spark, d):
    s = _event_stream(spark, d, "late").withColumn(
        "arrival_ts", F.col("ts") + F.make_dt_interval(mins=F.get_json_object("props", "$.k").try_cast("int") * 2))
    _, late = so.late_rows(s, "ts", "arrival_ts", "1 hour")
    return sr.run_stream(late.select("event_id", "user_id", "ts", "arrival_ts"), "late").result()


LATE_SQL = """
WITH a AS (SELECT ts, ts + CAST(json_extract_string(props, '$.k') AS INTEGER) * 3 * INTERVAL 1 HOUR AS arrival FROM events),
b AS (SELECT *, CAST(floor(date_diff('day', DATE '2024-01-01', CAST(arrival AS DATE)) / 7.0) AS INTEGER) AS batch FROM a),
m AS (SELECT batch, max(ts) AS top FROM b GROUP BY batch),
t AS (SELECT batch, date_trunc('millisecond', max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING)) - INTERVAL 1 HOUR AS threshold FROM m)
SELECT batch, count(*) AS input_rows, count(*) FILTER (ts <= threshold) AS dropped_rows, count(*) - count(*) FILTER (ts <= threshold) AS kept_rows,
       count(*) FILTER (arrival > ts + INTERVAL 1 HOUR) AS late_rows FROM b JOIN t USING (batch) GROUP BY batch"""


@register("watermark_late_drop", LATE_SQL)
def q_watermark_late_drop(spark, d):
    # events in the order of their arrival, a week a batch; those behind the
    # watermark are dropped, and the engine's count of them is the table's
    ev = T(spark, d).events.select("event_id", "ts", (F.col("ts") + F.make_dt_interval(
        hours=F.get_json_object("props", "$.k").try_cast("int") * 3)).alias("arrival_ts"))
    week = F.floor(F.datediff(F.to_date("arrival_ts"), F.lit("2024-01-01").cast("date")) / 7).cast("int")
    ev = ev.withColumn("batch", week)
    with ProgressLog(spark, scratch_path(spark, "late-log")) as log:
        run, ids = sr.run_in_order(ev.withColumn("week", week), "week", lambda s: so.deduplicated(_timed(s), ["event_id"], "ts", "1 hour"), "late-drop")
        for i in ids:
            log.wait(i)
    _, late = so.late_rows(ev, "ts", "arrival_ts", "1 hour")
    return so.late_drop_report(log.read(), run.result(), late, "batch", ids)


MODES_SQL = """
SELECT mode, CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total
FROM events, (VALUES ('append'), ('update'), ('complete')) AS m(mode) GROUP BY ALL"""


@register("stream_output_modes", MODES_SQL)
def q_stream_output_modes(spark, d):
    # one staged source for the three modes; the flush row closes the last windows for append
    events = sr.with_flush_row(T(spark, d).events, "ts", {"event_type": ["-"]}, after="3 days")
    each = sr.files_each(events, 4)
    path, schema = sr.stage_files(events, "modes-src", 4 * each, "ts")
    out = None
    for mode in ("append", "update", "complete"):
        s = _timed(sr.file_stream(spark, path, schema, max_files=each))
        agg = so.windowed(s, "ts", "1 day", keys=["event_type"], watermark="1 day",
                          aggs=[F.count(F.lit(1)).alias("n"), F.sum(dec("value")).alias("total")])
        rows = sr.settled(sr.emissions(agg, f"mode-{mode}", mode), mode, ["window_start", "event_type"]).where("event_type <> '-'")
        rows = rows.select(F.lit(mode).alias("mode"), "window_start", "event_type", "n", F.col("total").cast("double").alias("total"))
        out = rows if out is None else out.unionByName(rows)
    return out


@register("stream_running_totals", """
SELECT user_id, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total_value, count(*) AS n_events
FROM events GROUP BY user_id""")
def q_stream_running_totals(spark, d):
    s = _event_stream(spark, d, "running", max_files=3)
    agg = s.groupBy("user_id").agg(F.sum(dec("value")).alias("total_value"), F.count(F.lit(1)).alias("n_events"))
    out = sr.run_stream(agg, "running", "update", keys=["user_id"]).result()
    return out.withColumn("total_value", F.col("total_value").cast("double"))


SPELLS_SQL = """
WITH f AS (SELECT user_id, ts, CASE WHEN ts > lag(ts) OVER w + INTERVAL 10 MINUTE OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS fresh
           FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM f)
SELECT user_id, min(ts) AS spell_start, max(ts) AS last_seen, count(*) AS event_count FROM g GROUP BY user_id, k"""


def _spells(spark, d, max_files=2):
    events = T(spark, d).events.select("user_id", "ts")
    # the flush row lets the watermark pass the last spell's timer
    s = _timed(_staged(spark, sr.with_flush_row(events, "ts", {"user_id": [-1]}), "spells", BATCHES, "ts", max_files))
    spells = activity_spells(s, "user_id", "ts", 600, "1 hour", spell_buckets(input_bytes(events)))
    out = sr.run_stream(spells, "spells", conf=ROCKSDB).result().where("key >= 0")
    return out.select(F.col("key").alias("user_id"), *(F.col(c).cast("timestamp_ntz").alias(c) for c in ("spell_start", "last_seen")), "event_count")


@register("stream_user_spells", SPELLS_SQL)
def q_stream_user_spells(spark, d):
    return _spells(spark, d)


@register("stream_user_state", """
SELECT user_id, count(*) AS event_count, max(ts) AS last_seen FROM events GROUP BY user_id""")
def q_stream_user_state(spark, d):
    # totals of the closed spells: no state outlives its timer, and no total depends on when batches ran
    return _spells(spark, d).groupBy("user_id").agg(F.sum("event_count").alias("event_count"), F.max("last_seen").alias("last_seen"))


@register("stream_dedupe", """
SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events""")
def q_stream_dedupe(spark, d):
    s = _timed(_event_stream(spark, d, "dedupe", BATCHES, 1)).withColumn("day", F.to_date("ts"))
    dd = s.withWatermark("ts", "2 days").dropDuplicatesWithinWatermark(["user_id", "event_type", "day"])
    return sr.run_stream(dd.select("user_id", "event_type", "day"), "dedupe").result()


@register("stream_restart", "SELECT event_id, user_id, value FROM events")
def q_stream_restart(spark, d):
    ev = T(spark, d).events
    cut = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    path, each = scratch_path(spark, "restart-src"), sr.files_each(ev, 4)
    ev.where(cut).repartition(4 * each).write.mode("overwrite").parquet(path)
    base = scratch_path(spark, "restart")
    kw = dict(path=f"{base}/sink", checkpoint=f"{base}/checkpoint")
    stream = lambda: sr.file_stream(spark, path, ev.schema, max_files=2 * each).select("event_id", "user_id", "value")
    sr.run_stream(stream(), "restart", **kw)
    ev.where(~cut).repartition(4 * each).write.mode("append").parquet(path)  # new files arrive
    return sr.run_stream(stream(), "restart", **kw).result()       # resumes from the checkpoint


@register("stream_partitioned_sink", """
SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day
FROM events""")
def q_stream_partitioned_sink(spark, d):
    s = _event_stream(spark, d, "psink").select(
        "event_id", F.year("ts").alias("year"), F.month("ts").alias("month"), F.dayofmonth("ts").alias("day"))
    return sr.run_stream(s, "psink", partition_by=["year", "month", "day"]).result() \
        .select("event_id", "year", "month", "day")


@register("stream_quarantine", """
SELECT event_id, reasons FROM (
  SELECT event_id, list_filter([CASE WHEN NOT coalesce(value < 300, false) THEN 'value_below_300' END,
                               CASE WHEN NOT coalesce(json_extract_string(props, '$.k') IS NOT NULL, false) THEN 'props_has_k' END,
                               CASE WHEN NOT coalesce(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) < 95, false) THEN 'k_below_95' END],
                              lambda x: x IS NOT NULL) AS reasons FROM events)
WHERE len(reasons) > 0""")
def q_stream_quarantine(spark, d):
    s = _event_stream(spark, d, "dlq", max_files=3)
    base = scratch_path(spark, "dlq")

    def split_batch(batch, batch_id):
        good, bad = q.quarantine(batch, EVENT_RULES)
        # per-batch folders written with overwrite: a retried batch replaces itself
        batch.persist()                                    # both outputs from one read of the source
        good.write.mode("overwrite").parquet(f"{base}/good/_batch={batch_id}")
        bad.write.mode("overwrite").parquet(f"{base}/bad/_batch={batch_id}")
        batch.unpersist()
    qy = (s.writeStream.foreachBatch(split_batch).option("checkpointLocation", f"{base}/checkpoint")
          .trigger(availableNow=True).start())
    qy.awaitTermination()
    return spark.read.parquet(f"{base}/bad").select("event_id", "reasons")


FEATURES_SQL = """
SELECT event_id, user_id, CAST(hour(ts) AS INTEGER) AS hour_of_day, CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
       CASE WHEN value < 10 THEN 'small' WHEN value < 100 THEN 'medium' ELSE 'large' END AS amount_category, value
FROM events"""


@register("stream_features", FEATURES_SQL)
def q_stream_features(spark, d):
    s = _event_stream(spark, d, "features").transform(so.features, "ts", "value")
    s = s.select("event_id", "user_id", "hour_of_day", "day_of_week", "amount_category", "value")
    return sr.run_stream(s, "features").result()


@register("stream_end_to_end", """
WITH x AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS b, event_type, value FROM events
           WHERE value > 0 AND value < 300 AND event_type IS NOT NULL),
w AS (SELECT b AS window_start, event_type, value FROM x UNION ALL SELECT b - INTERVAL 5 MINUTE, event_type, value FROM x)
SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, event_type,
       CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total_amount, count(*) AS n_events
FROM w GROUP BY ALL""")
def q_stream_end_to_end(spark, d):
    ev = T(spark, d).events
    sent = F.get_json_object(F.col("value").cast("string"), "$.timestamp")
    raw = _staged(spark, to_messages(ev), "e2e", BATCHES, sent, 1)
    parsed = fs.parse_messages(raw, MSG_SCHEMA).withColumn("ts", F.col("timestamp").cast("timestamp"))
    clean = q.expect_or_drop(parsed, {"amount_positive": "amount > 0", "amount_bounded": "amount < 300",
                                      "has_type": "event_type IS NOT NULL"})
    agg = so.windowed(clean, "ts", "10 minutes", "5 minutes", keys=["event_type"], watermark="1 hour",
                      aggs=[F.sum(F.col("amount").cast("decimal(12,2)")).alias("total_amount"),
                            F.count(F.lit(1)).alias("n_events")])
    out = sr.run_stream(agg, "e2e", "update", keys=["window_start", "event_type"]).result()
    return out.withColumn("total_amount", F.col("total_amount").cast("double"))


@register("stream_progress", """
SELECT count(*) AS input_rows, true AS each_batch_once, true AS rates_known, 0 AS dropped_rows FROM events""")
def q_stream_progress(spark, d):
    s = _event_stream(spark, d, "progress", max_files=2)
    with ProgressLog(spark, scratch_path(spark, "progress-log")) as log:
        log.wait(sr.run_stream(s.select("event_id"), "progress").run_id)
    return log.read().agg(
        F.sum("input_rows").alias("input_rows"), (F.count("*") == F.count_distinct("run_id", "batch_id")).alias("each_batch_once"),
        F.bool_and((F.col("rows_per_sec") > 0) & (F.col("duration_ms") >= 0)).alias("rates_known"), F.sum("dropped_rows").cast("int").alias("dropped_rows"))


@register("stream_cdc_filter", """
SELECT user_id, event_id, _change_type FROM (
  SELECT user_id, event_id, CASE WHEN event_type = 'signup' THEN 'insert' WHEN event_type = 'error' THEN 'delete'
                                 ELSE 'update_postimage' END AS _change_type FROM events)
WHERE _change_type IN ('insert', 'update_postimage')""")
def q_stream_cdc_filter(spark, d):
    s = _staged(spark, versioned_feed(T(spark, d).events), "cdc", 8, "event_id").where(F.col("_change_type").isin(ch.INSERT, ch.POST))
    return sr.run_stream(s.select("user_id", "event_id", "_change_type"), "cdc").result()


# ====================================================================== stream joins

@register("stream_static_join", """
SELECT e.event_id, c.c_mktsegment, c.c_nationkey FROM events e JOIN customer c ON e.user_id = c.c_custkey""")
def q_stream_static_join(spark, d):
    s = _event_stream(spark, d, "static-join")
    cust = T(spark, d).customer.select("c_custkey", "c_mktsegment", "c_nationkey")
    j = s.join(cust, s.user_id == cust.c_custkey).select("event_id", "c_mktsegment", "c_nationkey")
    return sr.run_stream(j, "static-join").result()


JOIN_SQL = """
SELECT p.event_id AS purchase_id, v.event_id AS view_id
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
JOIN (SELECT * FROM events WHERE event_type = 'view') v
  ON p.user_id = v.user_id AND p.ts >= v.ts AND p.ts <= v.ts + INTERVAL 1 HOUR"""


def _stream_pair(spark, d, name):
    # a flush row on either side lets the watermark pass the last interval, so
    # an outer join gives out its last unmatched rows too
    s = _timed(_event_stream(spark, d, name, BATCHES, 1, flush={"user_id": [-1, -1], "event_type": ["purchase", "view"]}))
    p = s.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    v = s.where(F.col("event_type") == "view").select("event_id", "user_id", "ts")
    return p, v


@register("stream_stream_inner", JOIN_SQL)
def q_stream_stream_inner(spark, d):
    p, v = _stream_pair(spark, d, "ssj")
    j = so.interval_join(p, v, "user_id", "ts", "ts", "0 seconds", "1 hour",
                         left_watermark="2 hours", right_watermark="2 hours")
    return sr.run_stream(j.select(F.col("l.event_id").alias("purchase_id"), F.col("r.event_id").alias("view_id")),
                         "ssj").result().where("purchase_id IS NOT NULL")


@register("stream_stream_left", JOIN_SQL.replace("\nJOIN ", "\nLEFT JOIN "))
def q_stream_stream_left(spark, d):
    p, v = _stream_pair(spark, d, "ssl")
    j = so.interval_join(p, v, "user_id", "ts", "ts", "0 seconds", "1 hour", how="leftOuter",
                         left_watermark="2 hours", right_watermark="2 hours")
    return sr.run_stream(j.select(F.col("l.event_id").alias("purchase_id"), F.col("r.event_id").alias("view_id")),
                         "ssl").result().where("purchase_id IS NOT NULL")


# ====================================================================== CDC / privacy / scoring on streams

@register("stream_apply_changes", """
SELECT user_id, event_type, value, ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1 AND event_type <> 'error'""")
def q_stream_apply_changes(spark, d):
    src = cdc_source(T(spark, d).events)
    each = sr.files_each(src, 8)
    path, schema = sr.stage_files(src, "upsert-src", 8 * each, "sequence_num")
    base = scratch_path(spark, "upsert")
    table = KeyedSnapshot(spark, f"{base}/table", ["user_id"], ["sequence_num"], buckets_for(dir_bytes(spark, path)))
    upsert_stream(sr.file_stream(spark, path, schema, max_files=3 * each), table, f"{base}/checkpoint", "operation = 'DELETE'")
    return table.read(drop=["operation", "sequence_num"]).select("user_id", "event_type", "value", "ts")


@register("stream_pii_mask", f"SELECT doc_id, {_mask_sql('text')} AS text FROM documents")
def q_stream_pii_mask(spark, d):
    s = mask_pii(_staged(spark, T(spark, d).documents.select("doc_id", "text"), "pii", 4, "doc_id"), ["text"])
    return sr.run_stream(s, "pii").result()


@register("stream_score", SCORE_SQL.format(
    more=", w0 + lx.a::DOUBLE*wa + lx.b::DOUBLE*wb + lx.c::DOUBLE*wc > lx.y::DOUBLE * 1.5 AS flag"))
def q_stream_score(spark, d):
    data = line_features(T(spark, d))
    model = ml.fit_linear(data, LINE_FEATURES, "o_totalprice")
    s = ml.score_linear(_staged(spark, data, "score", 4, "o_orderkey"), model)
    s = s.withColumn("flag", F.col("prediction") > F.col("o_totalprice").cast("double") * 1.5)
    return sr.run_stream(s.select("o_orderkey", F.round("prediction", 4).alias("prediction"), "flag"), "score").result()


@register("incremental_ingest", "SELECT * FROM events")
def q_incremental_ingest(spark, d):
    s = _event_stream(spark, d, "ingest", max_files=2)
    return sr.run_stream(s, "ingest").result()
