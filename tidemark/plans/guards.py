"""Registered queries over checks and guarded writes (Q-03, Q-13, S-11, S-18,
Y-01) with oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import layout as ly
from tidemark.operators import quality as q
from tidemark.session import scratch_path
from tidemark.sources.contracts import SchemaContract, VersionedTable
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


GUARDS = {"keys": {"event_id_known": "event_id IS NOT NULL", "user_id_known": "user_id IS NOT NULL"},
          "amounts": {"value_not_negative": "value >= 0", "value_below_100": "value < 100"},
          "times": {"in_2024": "year(ts) = 2024"}}


def _guard_sql():
    parts = []
    for name, rules in GUARDS.items():
        ok = " AND ".join(f"coalesce({p}, false)" for p in rules.values())
        parts.append(f"SELECT '{name}' AS guard, CASE WHEN bool_and({ok}) THEN 'passed' ELSE 'failed' END AS outcome, "
                     f"CASE WHEN bool_and({ok}) THEN count(*) END AS rows_checked FROM events")
    return " UNION ALL ".join(parts)


@register("expect_fail", _guard_sql())
def q_expect_fail(spark, d):
    ev = tables(spark, d).events.select("event_id", "user_id", "value", "ts")
    done = [(name, *q.guarded_write(ev, rules, scratch_path(spark, f"guard-{name}"), name)[:2]) for name, rules in GUARDS.items()]
    return spark.createDataFrame(done, "guard string, outcome string, rows_checked bigint")


REQUIRED = {"orders": {"o_orderkey": "bigint", "o_totalprice": "double", "o_channel": "string"}, "events": {"event_id": "bigint", "ts": "timestamp_ntz", "value": "string"},
            "returns": {"r_id": "bigint"}, "labels": {"doc_id": "bigint", "toxic": ""}, "no_labels": {"doc_id": "bigint"}}


@register("input_validation", """
SELECT 'orders' AS table_name, 'missing column' AS problem, 'o_channel' AS detail
WHERE NOT EXISTS (SELECT 1 FROM information_schema.columns WHERE table_name = 'orders' AND column_name = 'o_channel')
UNION ALL SELECT 'events', 'other type', 'value ' || lower(data_type) FROM information_schema.columns WHERE table_name = 'events' AND column_name = 'value' AND data_type <> 'VARCHAR'
UNION ALL SELECT 'returns', 'missing table', NULL WHERE NOT EXISTS (SELECT 1 FROM information_schema.tables WHERE table_name = 'returns')
UNION ALL SELECT 'no_labels', 'empty', NULL WHERE NOT EXISTS (SELECT 1 FROM labels WHERE doc_id IS NULL)
UNION ALL SELECT 'labels', 'empty', NULL WHERE NOT EXISTS (SELECT 1 FROM labels)""")
def q_input_validation(spark, d):
    t = tables(spark, d)
    given = {"orders": t.orders, "events": t.events, "labels": t.labels, "no_labels": t.labels.where("doc_id IS NULL")}
    return q.input_report(spark, given, REQUIRED)


@register("schema_contract", """
SELECT batch, accepted, reason, CASE WHEN accepted THEN n ELSE 0 END AS rows_landed FROM (
  SELECT CASE WHEN ts < TIMESTAMP '2024-01-08' THEN 'week1' WHEN ts < TIMESTAMP '2024-01-15' THEN 'week2' WHEN ts < TIMESTAMP '2024-01-22' THEN 'week3' ELSE 'rest' END AS b, count(*) AS n
  FROM events GROUP BY 1) JOIN (VALUES ('week1', true, ''), ('week2', false, 'missing event_type; unexpected kind'), ('week3', false, 'value is string, not double'), ('rest', true, ''))
  AS v(batch, accepted, reason) ON b = batch""")
def q_schema_contract(spark, d):
    ev = tables(spark, d).events.select("event_id", "event_type", "value", "ts")
    base = scratch_path(spark, "contract")

    def before(day):
        return F.col("ts") < F.lit(day).cast("timestamp_ntz")

    weeks = {"week1": ev.where(before("2024-01-08")), "week2": ev.where(~before("2024-01-08") & before("2024-01-15")).withColumnRenamed("event_type", "kind"),
             "week3": ev.where(~before("2024-01-15") & before("2024-01-22")).withColumn("value", F.col("value").cast("string")), "rest": ev.where(~before("2024-01-22"))}
    for name, rows in weeks.items():
        rows.withColumn("batch", F.lit(name)).write.parquet(f"{base}/{name}")
    contract = SchemaContract(spark, f"{base}/schema").save(ev.withColumn("batch", F.lit("")).schema)
    report = contract.append({name: f"{base}/{name}" for name in weeks}, f"{base}/table")
    landed = spark.read.parquet(f"{base}/table").groupBy("batch").agg(F.count(F.lit(1)).alias("n"))
    return report.join(landed, "batch", "left").select("batch", "accepted", "reason", F.coalesce("n", F.lit(0)).alias("rows_landed"))


@register("overwrite_schema", """
SELECT event_id, user_id, CAST(value AS DECIMAL(12,2)) AS amount, CAST(ts AS DATE) AS day FROM events""")
def q_overwrite_schema(spark, d):
    ev = tables(spark, d).events
    table = VersionedTable(spark, scratch_path(spark, "versioned"))
    table.overwrite(ev.select("event_id", "value"))
    table.overwrite(ev.select("event_id", "user_id", F.col("value").cast("decimal(12,2)").alias("amount"), F.to_date("ts").alias("day")))
    return table.read()


@register("partition_sizes", """
SELECT layout, count(*) AS n_rows, sum(o_orderkey)::BIGINT AS key_sum, true AS as_many_as_bytes
FROM orders, (VALUES ('repartition'), ('coalesce')) AS l(layout) GROUP BY layout""")
def q_partition_sizes(spark, d):
    t = tables(spark, d)
    orders = t.orders.select("o_orderkey", "o_totalprice")
    size, target = ly.dir_bytes(spark, t.path("orders")), 64 * 1024
    want = ly.partitions_for(size, target)
    out = None
    for layout, df in (("repartition", ly.resized(orders, size, target)), ("coalesce", ly.resized(orders.repartition(want * 2), size, target, want * 2))):
        r = ly.partition_report(df, ["o_orderkey"]).agg(F.sum("n_rows").alias("n_rows"), F.sum("sum_o_orderkey").alias("key_sum"),
                                                      (F.count(F.lit(1)) <= want).alias("as_many_as_bytes")).withColumn("layout", F.lit(layout))
        out = r if out is None else out.unionByName(r)
    return out.select("layout", "n_rows", "key_sum", "as_many_as_bytes")
