"""Registered source/sink (S) and layout (Y) queries with oracle SQL.

Each writes what Spark derives from the driver tables into a fresh folder
under the shared checkpoint root and reads it back through the format or
layout under test, so the work grows with the tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

from tidemark.operators import layout as ly
from tidemark.session import scratch_path
from tidemark.sources import files as fs
from tidemark.sources.tables import tables

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


EVENTS_SCHEMA = StructType([StructField("event_id", LongType()), StructField("ts", TimestampNTZType()),
                            StructField("user_id", LongType()), StructField("event_type", StringType()),
                            StructField("value", DoubleType()), StructField("props", StringType())])


# ====================================================================== S

@register("scan_parquet", "SELECT event_id, user_id, value FROM events WHERE event_type = 'view'")
def q_scan_parquet(spark, d):
    df = fs.read(spark, T(spark, d).path("events"), "parquet")
    return df.where(F.col("event_type") == "view").select("event_id", "user_id", "value")


@register("csv_roundtrip", "SELECT * FROM customer")
def q_csv_roundtrip(spark, d):
    c = T(spark, d).customer
    back = fs.roundtrip(c, "csv", "csv", write_options={"header": "true"},
                        read_options={"header": "true", "inferSchema": "true"})
    return back.select(*[F.col(f.name).cast(f.dataType) for f in c.schema.fields])


@register("json_roundtrip", "SELECT * FROM events")
def q_json_roundtrip(spark, d):
    opts = {"timestampNTZFormat": fs.MICROS_NTZ}
    return fs.roundtrip(T(spark, d).events, "json", "json", schema=EVENTS_SCHEMA,
                        write_options=opts, read_options=opts)


@register("orc_roundtrip", "SELECT * FROM orders")
def q_orc_roundtrip(spark, d):
    return fs.roundtrip(T(spark, d).orders, "orc", "orc")


NATION_SCHEMA = StructType([StructField("n_nationkey", IntegerType()), StructField("n_name", StringType()),
                            StructField("n_regionkey", IntegerType())])


@register("xml_roundtrip", "SELECT * FROM nation")
def q_xml_roundtrip(spark, d):
    return fs.roundtrip(T(spark, d).nation, "xml", "xml", schema=NATION_SCHEMA,
                        write_options={"rowTag": "nation", "rootTag": "nations"},
                        read_options={"rowTag": "nation"})


@register("text_lines", """
SELECT line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY line""")
def q_text_lines(spark, d):
    docs = T(spark, d).documents.select("text")
    path = scratch_path(spark, "text")
    docs.write.mode("overwrite").text(path)
    return spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


@register("binary_inventory", """
SELECT lang, CAST(sum(strlen(text) + 1) AS BIGINT) AS n_bytes, count(DISTINCT lang) <= 1 AS whole FROM documents WHERE text IS NOT NULL GROUP BY lang""")
def q_binary_inventory(spark, d):
    # text files read back as bytes: a line break ends each text
    path = scratch_path(spark, "binary")
    T(spark, d).documents.where("text IS NOT NULL").select("lang", "text").write.partitionBy("lang").option("maxRecordsPerFile", 10_000).text(path)
    b = fs.read(spark, path, "binaryFile", pathGlobFilter="*.txt")
    return b.groupBy("lang").agg(F.sum("length").alias("n_bytes"), F.bool_and(F.col("length") == F.octet_length("content")).alias("whole"))


# Order priority labels (a small literal lookup table).
PRIORITY_LABELS = [("1-URGENT", "urgent"), ("2-HIGH", "high"), ("3-MEDIUM", "medium"),
                   ("4-NOT SPECIFIED", "unspecified"), ("5-LOW", "low")]


@register("literal_table", """
WITH labels(priority, label) AS (VALUES """ + ", ".join(f"('{a}', '{b}')" for a, b in PRIORITY_LABELS) + """)
SELECT l.label, count(*) AS n_orders FROM orders o JOIN labels l ON o.o_orderpriority = l.priority GROUP BY l.label""")
def q_literal_table(spark, d):
    schema = StructType([StructField("priority", StringType(), False), StructField("label", StringType(), False)])
    labels = spark.createDataFrame(PRIORITY_LABELS, schema)  # 5 fixed rows
    o = T(spark, d).orders
    return (o.join(F.broadcast(labels), o.o_orderpriority == labels.priority)
            .groupBy("label").agg(F.count(F.lit(1)).alias("n_orders")))


@register("schema_evolution", """
SELECT event_id, user_id, event_type, CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN value END AS value FROM events""")
def q_schema_evolution(spark, d):
    ev = T(spark, d).events
    path = scratch_path(spark, "evolve")
    cut = F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")
    ev.where(~cut).select("event_id", "user_id", "event_type").write.mode("overwrite").parquet(f"{path}/batch=1")
    ev.where(cut).select("event_id", "user_id", "event_type", "value").write.mode("overwrite") \
        .parquet(f"{path}/batch=2")
    merged = spark.read.option("mergeSchema", "true").parquet(path)
    return merged.select("event_id", "user_id", "event_type", "value")


MSG_SCHEMA = "user_id STRING, event_type STRING, amount DOUBLE, timestamp TIMESTAMP_NTZ, metadata MAP<STRING, STRING>"


def to_messages(ev):
    """Events as broker-style messages: binary key and a JSON binary value."""
    payload = F.to_json(F.struct(F.col("user_id").cast("string").alias("user_id"), "event_type",
                                 F.col("value").alias("amount"), F.col("ts").alias("timestamp"),
                                 F.from_json("props", "MAP<STRING, STRING>").alias("metadata")),
                       {"timestampNTZFormat": fs.MICROS_NTZ})
    return ev.select(F.col("event_id").cast("string").cast("binary").alias("key"),
                     payload.cast("binary").alias("value"))


PARSE_SQL = """
SELECT CAST(event_id AS VARCHAR) AS message_key, CAST(user_id AS VARCHAR) AS user_id, event_type,
       value AS amount, ts AS timestamp, json_extract_string(props, '$.k') AS k FROM events"""


@register("parse_messages", PARSE_SQL)
def q_parse_messages(spark, d):
    msgs = fs.roundtrip(to_messages(T(spark, d).events), "parquet", "messages")
    p = fs.parse_messages(msgs, MSG_SCHEMA)
    return p.select("message_key", "user_id", "event_type", "amount", "timestamp",
                    F.col("metadata")["k"].alias("k"))


@register("ingest_provenance", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS source_day, count(*) AS n_rows FROM events GROUP BY 1""")
def q_ingest_provenance(spark, d):
    path = scratch_path(spark, "landing")
    T(spark, d).events.withColumn("day", F.to_date("ts").cast("string")) \
        .write.mode("overwrite").partitionBy("day").parquet(path)
    p = fs.with_provenance(spark.read.schema(EVENTS_SCHEMA).parquet(path))
    return (p.withColumn("source_day", F.regexp_extract("source_file", r"day=([0-9-]+)", 1))
            .groupBy("source_day").agg(F.count(F.lit(1)).alias("n_rows")))


@register("partitioned_write", """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month, count(*) AS n_lines,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS revenue
FROM lineitem GROUP BY 1, 2""")
def q_partitioned_write(spark, d):
    li = T(spark, d).lineitem.withColumns({"year": F.year("l_shipdate"), "month": F.month("l_shipdate")})
    path = scratch_path(spark, "partitioned")
    # REBALANCE by the partition columns: AQE splits a partition value that
    # holds too many rows across several writers and merges small ones, so
    # there is neither a hot single-task month nor a file per task and month
    fs.write(li.hint("rebalance", "year", "month"), path, partition_by=["year", "month"])
    back = spark.read.parquet(path)
    return back.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).cast("double").alias("revenue"))


BUCKET_BYTES = 4 * 1024 * 1024   # of a file or bucket of these queries; a multiple of it at larger scale


@register("bucketed_join", """
SELECT o.o_orderstatus, count(*) AS n_lines FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_orderstatus""")
def q_bucketed_join(spark, d):
    return bucketed_join_frame(spark, d).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_lines"))


def bucketed_join_frame(spark, d, buckets: int | None = None):
    t = T(spark, d)
    buckets = buckets or ly.partitions_for(ly.dir_bytes(spark, t.path("lineitem")), BUCKET_BYTES)
    tag = uuid.uuid4().hex[:10]
    base = scratch_path(spark, "bucketed")
    li, od = f"tm_lineitem_b_{tag}", f"tm_orders_b_{tag}"
    fs.write_bucketed(t.lineitem.select("l_orderkey", "l_linenumber"), li, f"{base}/li", buckets,
                      "l_orderkey", "l_orderkey")
    fs.write_bucketed(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus"), od,
                      f"{base}/o", buckets, "l_orderkey", "l_orderkey")
    return spark.table(li).join(spark.table(od), "l_orderkey")


@register("append_only_parity", """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour_of_day, CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
       CASE WHEN value < 10 THEN 'small' WHEN value < 100 THEN 'medium' ELSE 'large' END AS amount_category
FROM events""")
def q_append_only_parity(spark, d):
    from tidemark.streaming import operators as so
    from tidemark.streaming import runner as sr
    ev = T(spark, d).events
    path, schema = sr.stage_files(ev, "parity-src", 8 * sr.files_each(ev, 8), "ts")
    stream = sr.file_stream(spark, path, schema).transform(so.features, "ts", "value")
    out = sr.run_stream(stream.select("event_id", "hour_of_day", "day_of_week", "amount_category"), "parity")
    return out.result()


@register("run_metrics", """
SELECT 'events_check' AS job, count(*) AS rows, count(*) FILTER (NOT coalesce(value > 0, false)) AS violations FROM events""")
def q_run_metrics(spark, d):
    from tidemark.operators.quality import expect
    ev = T(spark, d).events
    checked, obs = expect(ev, {"value_positive": "value > 0"})
    checked.write.format("noop").mode("overwrite").save()
    m = obs.get
    path = scratch_path(spark, "run-metrics")
    return fs.append_metrics(spark, {"job": "events_check", "rows": int(m["rows"]),
                                     "violations": int(m["value_positive"])}, path)


@register("ctas_daily_metrics", """
SELECT CAST(ts AS DATE) AS day, count(*) AS n_events, count(DISTINCT user_id) AS n_users,
       CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total_value FROM events GROUP BY 1""")
def q_ctas_daily_metrics(spark, d):
    ev = T(spark, d).events
    daily = ev.groupBy(F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n_events"), F.count_distinct("user_id").alias("n_users"),
        F.sum(F.col("value").cast("decimal(12,2)")).cast("double").alias("total_value"))
    return fs.ctas(daily, f"tm_daily_metrics_{uuid.uuid4().hex[:10]}", scratch_path(spark, "ctas"))


# ====================================================================== Y

@register("shared_base_outputs", """
SELECT 'by_type' AS output, event_type AS grp, count(*) AS n,
       CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total FROM events WHERE value > 5 GROUP BY event_type
UNION ALL
SELECT 'by_day', CAST(CAST(ts AS DATE) AS VARCHAR), count(*), CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE)
FROM events WHERE value > 5 GROUP BY CAST(ts AS DATE)""")
def q_shared_base_outputs(spark, d):
    base = T(spark, d).events.where(F.col("value") > 5).select("ts", "event_type", "value")

    def summary(key):
        return lambda b: b.groupBy(key.alias("grp")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(12,2)")).cast("double").alias("total"))
    outs = ly.fan_out(base, {"by_type": summary(F.col("event_type")),
                             "by_day": summary(F.to_date("ts").cast("string"))}, scratch_path(spark, "fanout"))
    return (outs["by_type"].withColumn("output", F.lit("by_type"))
            .unionByName(outs["by_day"].withColumn("output", F.lit("by_day"))))


@register("compact_files", "SELECT * FROM events")
def q_compact_files(spark, d):
    src = scratch_path(spark, "small-files")
    small = ly.partitions_for(ly.dir_bytes(spark, T(spark, d).path("events")), 64 * 1024)
    T(spark, d).events.repartition(small).write.mode("overwrite").parquet(src)
    dst = scratch_path(spark, "compacted")
    ly.compact(spark, src, dst, target_bytes=64 * 1024 * 1024)
    return spark.read.parquet(dst)


@register("zorder_layout", "SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice FROM lineitem")
def q_zorder_layout(spark, d):
    li = T(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")
    li = li.withColumn("_day", F.unix_date(F.to_date("l_shipdate")))
    path = scratch_path(spark, "zorder")
    n = ly.partitions_for(ly.dir_bytes(spark, T(spark, d).path("lineitem")), BUCKET_BYTES)
    ly.zorder(li, ["_day", "l_extendedprice"], partitions=n).drop("_day").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@register("pruned_scan", """
SELECT event_id, user_id, value, event_type FROM events WHERE event_type = 'error' AND value > 100""")
def q_pruned_scan(spark, d):
    path = scratch_path(spark, "by-type")
    T(spark, d).events.write.mode("overwrite").partitionBy("event_type").parquet(path)
    r = ly.pruned_read(spark, path, (F.col("event_type") == "error") & (F.col("value") > 100))
    return r.select("event_id", "user_id", "value", "event_type")
