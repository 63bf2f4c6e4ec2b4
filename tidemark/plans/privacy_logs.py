"""Registered privacy (G) and log-analytics (L) queries with oracle SQL.

Roles: ``customer`` is the PII table (region via nation), ``documents`` the
free text scanned for PII; ``events`` is the query/job/billing log (value =
duration or cost, ``error`` = failed run, props = statement text).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import logs as lg
from tidemark.operators import privacy as pv
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


E_SQL = pv.EMAIL_PATTERN
P_SQL = pv.PHONE_PATTERN
S_SQL = pv.SSN_PATTERN


def _cust_region(t):
    geo = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))  # 25 rows, fixed
    return t.customer.join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))


# ====================================================================== G

ROW_POLICY = {"global_access": "*", "america_analysts": "AMERICA", "europe_analysts": "EUROPE"}


@register("row_filter", """
SELECT c.c_custkey, r.r_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey WHERE r.r_name IN ('AMERICA', 'EUROPE')""")
def q_row_filter(spark, d):
    df = _cust_region(T(spark, d)).select("c_custkey", "r_name")
    return pv.row_filter(df, "r_name", ROW_POLICY, ["america_analysts", "europe_analysts", "unknown_group"])


@register("mask_email_tiers", f"""
SELECT doc_id, left(split_part(email, '@', 1), 2) || '***@' || split_part(email, '@', 2) AS masked_email
FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{E_SQL}')) AS email FROM documents)""")
def q_mask_email_tiers(spark, d):
    e = pv.extract_emails(T(spark, d).documents.select("doc_id", "text"), "text")
    return e.select("doc_id", pv.email_mask_tier(F.col("email"), ["masked_access"]).alias("masked_email"))


@register("email_domains", f"""
SELECT doc_id, lower(split_part(email, '@', 2)) AS email_domain FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{E_SQL}')) AS email FROM documents)""")
def q_email_domains(spark, d):
    e = pv.extract_emails(T(spark, d).documents.select("doc_id", "text"), "text")
    return pv.generalize(e, domains={"email_domain": "email"}).select("doc_id", "email_domain")


@register("hash_ids", """
SELECT c_custkey, sha256(CAST(c_custkey AS VARCHAR)) AS c_custkey_hash FROM customer""")
def q_hash_ids(spark, d):
    return pv.hash_ids(T(spark, d).customer, ["c_custkey"]).select("c_custkey", "c_custkey_hash")


SALT = "tidemark_salt"


@register("tokenize", f"""
SELECT c_custkey, sha256(c_name || '{SALT}') AS c_name_token, c_name AS c_name_restored FROM customer""")
def q_tokenize(spark, d):
    toks, mapping = pv.tokenize(T(spark, d).customer.select("c_custkey", "c_name"), "c_name", SALT)
    back = pv.detokenize(toks.drop("c_name"), mapping, "c_name_token", "c_name_restored")
    return back.select("c_custkey", "c_name_token", "c_name_restored")


@register("suppress", """
SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_name, CAST(NULL AS DOUBLE) AS c_acctbal, c_mktsegment FROM customer""")
def q_suppress(spark, d):
    return pv.suppress(T(spark, d).customer, ["c_name", "c_acctbal"]) \
        .select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


BAL_BANDS = [(0, "negative"), (2500, "low"), (5000, "mid")]


@register("generalize", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal < 2500 THEN 'low'
                       WHEN c_acctbal < 5000 THEN 'mid' ELSE 'high' END AS balance_band,
       substring(c_mktsegment, 1, 3) AS segment_prefix
FROM customer""")
def q_generalize(spark, d):
    g = pv.generalize(T(spark, d).customer, bands={"balance_band": ("c_acctbal", BAL_BANDS, "high")},
                      prefixes={"segment_prefix": ("c_mktsegment", 3)})
    return g.select("c_custkey", "balance_band", "segment_prefix")


@register("anonymized_extract", """
WITH o AS (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS spend,
                  CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS first_order_month
           FROM orders GROUP BY o_custkey)
SELECT sha256(CAST(c.c_custkey AS VARCHAR)) AS customer_hash,
       CASE WHEN c.c_acctbal < 0 THEN 'negative' WHEN c.c_acctbal < 2500 THEN 'low'
            WHEN c.c_acctbal < 5000 THEN 'mid' ELSE 'high' END AS balance_band,
       n.n_name, o.first_order_month,
       CASE WHEN o.spend < 100000 THEN 'low' WHEN o.spend < 1000000 THEN 'medium' ELSE 'high' END AS purchase_category
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN o ON c.c_custkey = o.o_custkey""")
def q_anonymized_extract(spark, d):
    t = T(spark, d)
    o = t.orders.groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("spend"),
                                          F.to_date(F.min("o_orderdate")).alias("first_order"))
    base = (t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(o, F.col("c_custkey") == F.col("o_custkey")))
    g = pv.generalize(pv.hash_ids(base, ["c_custkey"]),
                      bands={"balance_band": ("c_acctbal", BAL_BANDS, "high"),
                             "purchase_category": ("spend", [(100000, "low"), (1000000, "medium")], "high")},
                      months={"first_order_month": "first_order"})
    return g.select(F.col("c_custkey_hash").alias("customer_hash"), "balance_band", "n_name",
                    "first_order_month", "purchase_category")


@register("pii_detect", f"""
SELECT doc_id, coalesce(regexp_matches(text, '{E_SQL}'), false) AS text_has_email,
       coalesce(regexp_matches(text, '{P_SQL}'), false) AS text_has_phone,
       coalesce(regexp_matches(text, '{S_SQL}'), false) AS text_has_ssn
FROM documents""")
def q_pii_detect(spark, d):
    return pv.detect_pii(T(spark, d).documents.select("doc_id", "text"), ["text"]).drop("text")


def _mask_sql(col):
    e = pv.EMAIL_MASK_PATTERN
    p = pv.PHONE_MASK_PATTERN
    return (f"regexp_replace(regexp_replace(regexp_replace({col}, '{pv.SSN_PATTERN}', '{pv.SSN_MASK}', 'g'), "
            f"'{e}', '\\1***@\\2.***', 'g'), '{p}', '\\1-***-\\2', 'g')")


@register("pii_mask", f"SELECT doc_id, {_mask_sql('text')} AS text FROM documents")
def q_pii_mask(spark, d):
    return pv.mask_pii(T(spark, d).documents.select("doc_id", "text"), ["text"])


PROFILE_COLS = ["text", "lang", "source"]


@register("pii_column_profile", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{k}' AS pii_kind, count(*) AS rows, "
    f"count(*) FILTER (WHERE coalesce(regexp_matches({c}, '{p}'), false)) AS matches, "
    f"CAST(count(*) FILTER (WHERE coalesce(regexp_matches({c}, '{p}'), false)) AS DOUBLE) / count(*) AS match_rate "
    f"FROM documents" for c in PROFILE_COLS for k, p in pv.PII_PATTERNS.items()))
def q_pii_column_profile(spark, d):
    return pv.pii_profile(T(spark, d).documents.select(*PROFILE_COLS))


# ====================================================================== L

@register("log_slowest", """
SELECT event_id, user_id, value, left(props, 5) AS text_preview FROM events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20' ORDER BY value DESC, event_id LIMIT 20""")
def q_log_slowest(spark, d):
    s = lg.slowest(T(spark, d).events, "value", "ts", dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20),
                   20, "props", 5, "event_id")
    return s.select("event_id", "user_id", "value", "text_preview")


@register("log_expensive", """
SELECT props, count(*) AS n_runs, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / count(value) AS avg_duration
FROM events GROUP BY props
HAVING CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / count(value) > 60 AND count(*) > 1""")
def q_log_expensive(spark, d):
    return lg.expensive_repeats(T(spark, d).events, "props", "value", 60, 1)


@register("log_resource_stats", """
SELECT user_id, count(*) AS n_queries, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / count(value) AS avg_duration,
       count(*) FILTER (WHERE value > 30) AS n_slow
FROM events GROUP BY user_id""")
def q_log_resource_stats(spark, d):
    return lg.resource_stats(T(spark, d).events, "user_id", "value", 30)


@register("log_failure_rate", """
SELECT user_id, count(*) AS n_runs, count(*) FILTER (WHERE event_type = 'error') AS n_failed,
       CAST(count(*) FILTER (WHERE event_type = 'error') AS DOUBLE) / count(*) AS failure_rate
FROM events GROUP BY user_id HAVING CAST(count(*) FILTER (WHERE event_type = 'error') AS DOUBLE) / count(*) > 0.25""")
def q_log_failure_rate(spark, d):
    return lg.failure_rate(T(spark, d).events, "user_id", F.col("event_type") == "error", 0.25)


@register("log_failures", """
SELECT event_id, user_id, ts FROM events
WHERE event_type IN ('error') AND ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-22'""")
def q_log_failures(spark, d):
    f = lg.failures_in_window(T(spark, d).events, "event_type", ["error"], "ts",
                              dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 22))
    return f.select("event_id", "user_id", "ts")


@register("log_error_counts", """
SELECT props, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY props""")
def q_log_error_counts(spark, d):
    return lg.message_counts(T(spark, d).events, "props", F.col("event_type") == "error")


@register("log_long_runs", """
SELECT event_id, event_type, value, avg_prev FROM (
  SELECT event_id, event_type, value,
         CAST(sum(CAST(value AS DECIMAL(12,2))) OVER w AS DOUBLE) / count(value) OVER w AS avg_prev
  FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING))
WHERE value > 1.5 * avg_prev""")
def q_log_long_runs(spark, d):
    r = lg.long_runs(T(spark, d).events, "event_type", ["ts", "event_id"], "value", 1.5,
                     bucket=F.to_date("ts"))
    return r.select("event_id", "event_type", "value", "avg_prev")


@register("log_access", """
SELECT user_id, event_type, count(*) AS access_count, max(ts) AS last_access
FROM events WHERE ts >= TIMESTAMP '2024-01-23' GROUP BY user_id, event_type""")
def q_log_access(spark, d):
    return lg.access_pattern(T(spark, d).events, "user_id", "event_type", "ts", dt.datetime(2024, 1, 23))


@register("log_costs", """
SELECT CAST(e.ts AS DATE) AS usage_date, e.event_type, c.c_mktsegment,
       CAST(sum(CAST(e.value AS DECIMAL(12,2))) AS DOUBLE) AS total_cost, count(*) AS n_records
FROM events e JOIN customer c ON e.user_id = c.c_custkey GROUP BY 1, 2, 3""")
def q_log_costs(spark, d):
    t = T(spark, d)
    j = t.events.join(t.customer.select("c_custkey", "c_mktsegment"), F.col("user_id") == F.col("c_custkey"))
    return lg.costs(j, "ts", ["event_type", "c_mktsegment"], "value")


@register("log_idle", """
SELECT user_id, day, first_seen, last_seen, date_sub('hour', first_seen, last_seen) AS hours_up FROM (
  SELECT user_id, CAST(ts AS DATE) AS day, min(ts) AS first_seen, max(ts) AS last_seen FROM events GROUP BY 1, 2)
WHERE date_sub('hour', first_seen, last_seen) > 12""")
def q_log_idle(spark, d):
    return lg.idle_resources(T(spark, d).events, "user_id", "ts", 12)


@register("log_flow_metrics", """
SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n_rows, count(DISTINCT user_id) AS n_users,
       CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total_amount
FROM events GROUP BY 1, 2""")
def q_log_flow_metrics(spark, d):
    return lg.flow_metrics(T(spark, d).events, "event_type", "ts", "user_id", "value")


@register("log_timeouts", """
SELECT user_id, CAST(sum(CAST(value AS DECIMAL(12,2)) * 60) AS DOUBLE) / count(*) AS avg_success_sec,
       greatest(3600.0, 3.0 * (CAST(sum(CAST(value AS DECIMAL(12,2)) * 60) AS DOUBLE) / count(*))) AS timeout_sec
FROM events WHERE event_type <> 'error' GROUP BY user_id""")
def q_log_timeouts(spark, d):
    ev = T(spark, d).events
    return lg.history_timeouts(ev, "user_id", F.col("value").cast("decimal(12,2)") * 60,
                               F.col("event_type") != "error")


@register("lineage_direct", """
WITH e AS (SELECT CAST(floor(c_custkey / 2) AS BIGINT) AS src, CAST(c_custkey AS BIGINT) AS dst
           FROM customer WHERE c_custkey >= 2),
up AS (SELECT dst AS node, count(DISTINCT src) AS n_upstream FROM e GROUP BY dst),
down AS (SELECT src AS node, count(DISTINCT dst) AS n_downstream FROM e GROUP BY src)
SELECT coalesce(up.node, down.node) AS node, coalesce(n_upstream, 0) AS n_upstream, coalesce(n_downstream, 0) AS n_downstream
FROM up FULL OUTER JOIN down ON up.node = down.node""")
def q_lineage_direct(spark, d):
    return lg.direct_lineage(T(spark, d).lineage_edges(), "src", "dst")
