"""Registered change-data (C) and data-quality (Q) queries with oracle SQL.

Roles over ``events``: the per-user state over a time window is a table
version; each event is a change of its user (``signup`` insert, ``error``
delete, anything else update), ``event_id`` is the sequence and the day of
month is the commit version.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import changes as ch
from tidemark.operators import joins as jn
from tidemark.operators import quality as q
from tidemark.plans.relational import STATE_SQL, _user_window_state, dec
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


D1, D10, D20, D31 = (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20),
                     dt.datetime(2024, 1, 31))


def _states(spark, d):
    ev = T(spark, d).events
    return _user_window_state(ev, D1, D20), _user_window_state(ev, D10, D31), _user_window_state(ev, D20, D31)


STATE3_SQL = STATE_SQL + """,
s AS (SELECT user_id, count(*) AS n_events, sum(CAST(value AS DECIMAL(12,2))) AS total_value FROM events
      WHERE ts >= TIMESTAMP '2024-01-20' AND ts < TIMESTAMP '2024-01-31' GROUP BY user_id)"""


def _out(df):
    return df.withColumn("total_value", F.col("total_value").cast("double"))


def cdc_source(ev):
    """Events as CDC rows: operation + sequence number."""
    op = (F.when(F.col("event_type") == "error", "DELETE")
          .when(F.col("event_type") == "signup", "INSERT").otherwise("UPDATE"))
    return ev.select("user_id", "event_type", "value", "ts", op.alias("operation"),
                     F.col("event_id").alias("sequence_num"))


def versioned_feed(ev):
    """Events as a change feed with a commit version that only grows (days since
    the end of 2023)."""
    kind = (F.when(F.col("event_type") == "signup", ch.INSERT)
            .when(F.col("event_type") == "error", ch.DELETE).otherwise(ch.POST))
    return ev.select("user_id", "event_id", "event_type", "value",
                     F.datediff(F.to_date("ts"), F.lit("2023-12-31").cast("date")).cast("bigint").alias("_version"), kind.alias("_change_type"))


FEED_SQL = """feed AS (
  SELECT user_id, event_id, event_type, value, CAST(date_diff('day', DATE '2023-12-31', CAST(ts AS DATE)) AS BIGINT) AS _version,
         CASE WHEN event_type = 'signup' THEN 'insert' WHEN event_type = 'error' THEN 'delete'
              ELSE 'update_postimage' END AS _change_type
  FROM events)"""


# ====================================================================== C

@register("merge_upsert", "WITH " + STATE3_SQL + """
SELECT coalesce(b.user_id, s.user_id) AS user_id,
       CASE WHEN s.user_id IS NOT NULL THEN s.n_events ELSE b.n_events END AS n_events,
       CAST(CASE WHEN s.user_id IS NOT NULL THEN s.total_value ELSE b.total_value END AS DOUBLE) AS total_value
FROM b FULL OUTER JOIN s ON b.user_id = s.user_id""")
def q_merge_upsert(spark, d):
    b, _, s = _states(spark, d)
    return _out(ch.merge(b, s, ["user_id"]))


@register("merge_separate_columns", "WITH " + STATE3_SQL + """
SELECT coalesce(b.user_id, s.user_id) AS user_id, CASE WHEN b.user_id IS NULL THEN NULL WHEN s.user_id IS NULL THEN b.n_events ELSE s.n_events + 1000 END AS n_events,
       CAST(CASE WHEN b.user_id IS NULL THEN s.total_value ELSE b.total_value END AS DOUBLE) AS total_value
FROM b FULL OUTER JOIN s ON b.user_id = s.user_id""")
def q_merge_separate_columns(spark, d):
    # matched rows take one set of columns, new rows another
    b, _, s = _states(spark, d)
    return _out(ch.merge(b, s, ["user_id"], update={"n_events": F.col("n_events") + 1000}, insert=["total_value"]))


@register("merge_insert_only", "WITH " + STATE3_SQL + """
SELECT user_id, n_events, CAST(total_value AS DOUBLE) AS total_value FROM b
UNION ALL
SELECT user_id, n_events, CAST(total_value AS DOUBLE) FROM s WHERE user_id NOT IN (SELECT user_id FROM b)""")
def q_merge_insert_only(spark, d):
    b, _, s = _states(spark, d)
    return _out(jn.insert_only(b, s, ["user_id"]))


@register("apply_changes", """
SELECT user_id, event_type, value, ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1 AND event_type <> 'error'""")
def q_apply_changes(spark, d):
    src = cdc_source(T(spark, d).events)
    return ch.apply_changes(src, ["user_id"], ["sequence_num"], deletes="operation = 'DELETE'",
                            except_columns=["operation", "sequence_num"])


@register("change_feed", "WITH " + STATE_SQL + """,
j AS (SELECT b.user_id AS bu, a.user_id AS au, b.n_events AS bn, a.n_events AS an,
             b.total_value AS bv, a.total_value AS av FROM b FULL OUTER JOIN a ON b.user_id = a.user_id)
SELECT au AS user_id, an AS n_events, CAST(av AS DOUBLE) AS total_value, 'insert' AS _change_type FROM j WHERE bu IS NULL
UNION ALL SELECT bu, bn, CAST(bv AS DOUBLE), 'delete' FROM j WHERE au IS NULL
UNION ALL SELECT bu, bn, CAST(bv AS DOUBLE), 'update_preimage' FROM j
  WHERE bu IS NOT NULL AND au IS NOT NULL AND (bn IS DISTINCT FROM an OR bv IS DISTINCT FROM av)
UNION ALL SELECT au, an, CAST(av AS DOUBLE), 'update_postimage' FROM j
  WHERE bu IS NOT NULL AND au IS NOT NULL AND (bn IS DISTINCT FROM an OR bv IS DISTINCT FROM av)""")
def q_change_feed(spark, d):
    b, a, _ = _states(spark, d)
    return _out(ch.change_feed(b, a, ["user_id"]))


@register("changes_between", "WITH " + FEED_SQL + """
SELECT _version, _change_type, count(*) AS n_changes FROM feed
WHERE _version BETWEEN 5 AND 10 AND _change_type IN ('insert', 'update_postimage')
GROUP BY _version, _change_type""")
def q_changes_between(spark, d):
    f = ch.changes_between(versioned_feed(T(spark, d).events), 5, 10, types=[ch.INSERT, ch.POST])
    return f.groupBy("_version", "_change_type").agg(F.count(F.lit(1)).alias("n_changes"))


AS_OF_SQL = """asof_{v} AS (
  SELECT user_id, event_id, event_type, value FROM feed WHERE _version <= {v}
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY _version DESC, event_id DESC) = 1
      AND _change_type <> 'delete')"""


@register("as_of_version", "WITH " + FEED_SQL + ", " + AS_OF_SQL.format(v=15) + " SELECT * FROM asof_15")
def q_as_of_version(spark, d):
    f = versioned_feed(T(spark, d).events)
    return ch.as_of(f, ["user_id"], 15, sequence_col="event_id").select("user_id", "event_id", "event_type", "value")


@register("restore_diff", "WITH " + FEED_SQL + ", " + AS_OF_SQL.format(v=15) + ", "
          + AS_OF_SQL.format(v=10 ** 9).replace("asof_1000000000", "cur") + """,
j AS (SELECT c.user_id AS cu, p.user_id AS pu, c.event_id AS ce, p.event_id AS pe, c.event_type AS ct,
             p.event_type AS pt, c.value AS cv, p.value AS pv FROM cur c FULL OUTER JOIN asof_15 p ON c.user_id = p.user_id),
ch AS (SELECT *, (ce IS DISTINCT FROM pe OR ct IS DISTINCT FROM pt OR cv IS DISTINCT FROM pv) AS changed FROM j)
SELECT pu AS user_id, pe AS event_id, pt AS event_type, pv AS value, 'insert' AS _change_type FROM ch WHERE cu IS NULL
UNION ALL SELECT cu, ce, ct, cv, 'delete' FROM ch WHERE pu IS NULL
UNION ALL SELECT cu, ce, ct, cv, 'update_preimage' FROM ch WHERE cu IS NOT NULL AND pu IS NOT NULL AND changed
UNION ALL SELECT pu, pe, pt, pv, 'update_postimage' FROM ch WHERE cu IS NOT NULL AND pu IS NOT NULL AND changed""")
def q_restore_diff(spark, d):
    f = versioned_feed(T(spark, d).events)
    return ch.restore_diff(f, ["user_id"], 15, ["event_id", "event_type", "value"], sequence_col="event_id")


@register("update_where", """
SELECT o_orderkey, CASE WHEN o_totalprice > 300000 AND o_orderstatus = 'O' THEN '0-EXPEDITE'
                        ELSE o_orderpriority END AS o_orderpriority
FROM orders""")
def q_update_where(spark, d):
    o = T(spark, d).orders
    return ch.update_where(o, "o_totalprice > 300000 AND o_orderstatus = 'O'",
                           {"o_orderpriority": "0-EXPEDITE"}).select("o_orderkey", "o_orderpriority")


RETENTION_DAYS_SQL = "CASE event_type WHEN 'error' THEN 7 WHEN 'view' THEN 14 ELSE 30 END"


@register("retention_purge", f"""
SELECT event_type,
       count(*) FILTER (WHERE NOT (CAST(ts AS DATE) < DATE '2024-01-31' - {RETENTION_DAYS_SQL})) AS kept,
       count(*) FILTER (WHERE CAST(ts AS DATE) < DATE '2024-01-31' - {RETENTION_DAYS_SQL}) AS purged
FROM events GROUP BY event_type""")
def q_retention_purge(spark, d):
    ev = T(spark, d).events
    # fixed retention days per record class
    days = F.when(F.col("event_type") == "error", 7).when(F.col("event_type") == "view", 14).otherwise(30)
    return ch.purge_report(ev, "ts", days, dt.date(2024, 1, 31), ["event_type"])


@register("erase_subjects", """
WITH req AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'error' AND CAST(ts AS DATE) = DATE '2024-01-05')
SELECT c.c_custkey, CASE WHEN r.user_id IS NOT NULL THEN '[ERASED]' ELSE c.c_name END AS c_name,
       r.user_id IS NOT NULL AS is_erased,
       CASE WHEN r.user_id IS NOT NULL THEN TIMESTAMP '2024-02-01 00:00:00' END AS erased_at
FROM customer c LEFT JOIN req r ON c.c_custkey = r.user_id""")
def q_erase_subjects(spark, d):
    t = T(spark, d)
    req = t.events.where((F.col("event_type") == "error") & (F.to_date("ts") == F.lit(dt.date(2024, 1, 5))))
    out = ch.erase(t.customer, req, "c_custkey", ["c_name"], request_key="user_id",
                   erased_at=dt.datetime(2024, 2, 1))
    return out.select("c_custkey", "c_name", "is_erased", "erased_at")


@register("change_ratio", "WITH " + FEED_SQL + """
SELECT _version, count(*) AS total_changes, count(*) FILTER (WHERE _change_type <> 'insert') AS non_insert,
       CAST(count(*) FILTER (WHERE _change_type <> 'insert') AS DOUBLE) / count(*) AS change_ratio,
       CAST(count(*) FILTER (WHERE _change_type <> 'insert') AS DOUBLE) / count(*) > 0.1 AS triggered
FROM feed GROUP BY _version""")
def q_change_ratio(spark, d):
    return ch.change_ratio(versioned_feed(T(spark, d).events), 0.1, by=["_version"])


# ====================================================================== Q

EVENT_RULES = {
    "value_below_300": "value < 300",
    "props_has_k": "get_json_object(props, '$.k') IS NOT NULL",
    "k_below_95": "TRY_CAST(get_json_object(props, '$.k') AS INT) < 95",
}
EVENT_RULES_SQL = {
    "value_below_300": "value < 300",
    "props_has_k": "json_extract_string(props, '$.k') IS NOT NULL",
    "k_below_95": "TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) < 95",
}


def _ok_sql(p):
    return f"coalesce({p}, false)"


@register("expect_warn", "\nUNION ALL\n".join(
    f"SELECT '{n}' AS rule, count(*) AS rows_checked, "
    f"CAST(sum(CASE WHEN {_ok_sql(p)} THEN 0 ELSE 1 END) AS BIGINT) AS violations FROM events"
    for n, p in EVENT_RULES_SQL.items()))
def q_expect_warn(spark, d):
    return q.violation_counts(T(spark, d).events, EVENT_RULES)


@register("expect_drop", "SELECT event_id FROM events WHERE " + " AND ".join(
    _ok_sql(p) for p in EVENT_RULES_SQL.values()))
def q_expect_drop(spark, d):
    return q.expect_or_drop(T(spark, d).events, EVENT_RULES).select("event_id")


@register("quarantine_good", "SELECT event_id, user_id FROM events WHERE " + " AND ".join(
    _ok_sql(p) for p in EVENT_RULES_SQL.values()))
def q_quarantine_good(spark, d):
    good, _ = q.quarantine(T(spark, d).events, EVENT_RULES)
    return good.select("event_id", "user_id")


@register("quarantine_bad", """
SELECT event_id, reasons FROM (
  SELECT event_id, list_filter([""" + ", ".join(
    f"CASE WHEN NOT {_ok_sql(p)} THEN '{n}' END" for n, p in EVENT_RULES_SQL.items()) + """],
         lambda x: x IS NOT NULL) AS reasons FROM events)
WHERE len(reasons) > 0""")
def q_quarantine_bad(spark, d):
    _, bad = q.quarantine(T(spark, d).events, EVENT_RULES)
    return bad.select("event_id", "reasons")


@register("check_rules", """
SELECT o_orderstatus, count(*) AS n_orders FROM orders
WHERE coalesce(o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM'), false)
GROUP BY o_orderstatus""")
def q_check_rules(spark, d):
    rules = [("positive_price", "o_totalprice > 0", "fail"),
             ("priority_known", "o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')", "drop"),
             ("has_status", "o_orderstatus IS NOT NULL", "warn")]
    kept = q.check_rules(T(spark, d).orders, rules)
    return kept.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"))


@register("generated_columns", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year, CAST(o_orderdate AS DATE) AS order_date,
       coalesce(o_orderpriority, 'UNKNOWN') AS o_orderpriority
FROM orders""")
def q_generated_columns(spark, d):
    o = T(spark, d).orders
    g = q.with_generated(o, {"order_year": "year(o_orderdate)", "order_date": "CAST(o_orderdate AS DATE)"},
                         defaults={"o_orderpriority": "UNKNOWN"})
    return g.select("o_orderkey", "order_year", "order_date", "o_orderpriority")


@register("quality_score", """
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL AND d.lang IS NOT NULL AND l.quality IS NOT NULL THEN 1.0 ELSE 0.5 END
         AS quality_score
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def q_quality_score(spark, d):
    t = T(spark, d)
    j = t.documents.select("doc_id", "text", "lang").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return q.quality_score(j, ["text", "lang", "quality"]).select("doc_id", "quality_score")


@register("quality_report", """
SELECT event_type, count(*) AS total_rows, count(DISTINCT user_id) AS distinct_keys,
       count(*) FILTER (WHERE user_id IS NULL) AS missing_keys,
       count(*) FILTER (WHERE ts > TIMESTAMP '2024-01-25') AS future_rows
FROM events GROUP BY event_type""")
def q_quality_report(spark, d):
    return q.quality_report(T(spark, d).events, "user_id", "ts", dt.datetime(2024, 1, 25), by=["event_type"])


@register("null_rate_gate", """
SELECT d.lang, count(*) AS rows, avg(CASE WHEN l.quality IS NULL THEN 1 ELSE 0 END) AS null_rate,
       avg(CASE WHEN l.quality IS NULL THEN 1 ELSE 0 END) > 0.05 AS breach
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.lang""")
def q_null_rate_gate(spark, d):
    t = T(spark, d)
    j = t.documents.select("doc_id", "lang").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return q.null_rate(j, "quality", ["lang"], 0.05)


@register("freshness", """
SELECT event_type, max(ts) AS last_ts, date_sub('hour', max(ts), TIMESTAMP '2024-02-01') AS hours_since,
       date_sub('hour', max(ts), TIMESTAMP '2024-02-01') > 24 AS is_stale
FROM events GROUP BY event_type""")
def q_freshness(spark, d):
    return q.freshness(T(spark, d).events, "ts", dt.datetime(2024, 2, 1), 24, by=["event_type"])


@register("volume_anomaly", """
WITH days AS (SELECT CAST(ts AS DATE) AS day, count(*) AS row_count FROM events GROUP BY 1),
s AS (SELECT day, row_count, avg(row_count) OVER w AS mean_prior, stddev_samp(row_count) OVER w AS stddev_prior
      FROM days WINDOW w AS (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT day, row_count, round(mean_prior, 6) AS mean_prior, round(stddev_prior, 6) AS stddev_prior,
       round(abs(row_count - mean_prior) / nullif(stddev_prior, 0), 6) AS z_score,
       coalesce(abs(row_count - mean_prior) / nullif(stddev_prior, 0) > 2, false) AS is_anomaly
FROM s""")
def q_volume_anomaly(spark, d):
    v = q.volume_anomaly(T(spark, d).events, "ts", 2.0)
    return v.select("day", "row_count", *[F.round(c, 6).alias(c) for c in ("mean_prior", "stddev_prior", "z_score")],
                    "is_anomaly")


@register("revenue_variance", """
WITH daily AS (SELECT CAST(ts AS DATE) AS day, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS revenue
               FROM events WHERE event_type = 'purchase' GROUP BY 1),
s AS (SELECT day, revenue, sum(revenue) OVER w / count(revenue) OVER w AS avg_prior_7
      FROM daily WINDOW w AS (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT day, revenue, avg_prior_7, (revenue - avg_prior_7) / nullif(avg_prior_7, 0) * 100 AS variance_pct,
       coalesce((revenue - avg_prior_7) / nullif(avg_prior_7, 0) * 100 NOT BETWEEN -20 AND 50, false) AS is_alert
FROM s""")
def q_revenue_variance(spark, d):
    from pyspark.sql import Window
    daily = (T(spark, d).events.where(F.col("event_type") == "purchase")
             .groupBy(F.to_date("ts").alias("day")).agg(F.sum(dec("value")).cast("double").alias("revenue")))
    w = Window.orderBy("day").rowsBetween(-7, -1)
    s = daily.withColumn("avg_prior_7", F.sum("revenue").over(w) / F.count("revenue").over(w))
    var = F.try_divide(F.col("revenue") - F.col("avg_prior_7"), F.col("avg_prior_7")) * 100
    return s.select("day", "revenue", "avg_prior_7", var.alias("variance_pct"),
                    F.coalesce(~var.between(-20, 50), F.lit(False)).alias("is_alert"))
