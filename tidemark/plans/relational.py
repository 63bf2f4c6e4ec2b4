"""Registered queries for projection/filter (P), joins (J), aggregation (A),
windows (W), sort/set operations (O) and scalar function families (F), each
with its DuckDB oracle SQL.

Conventions that keep Spark and DuckDB bit-identical: amounts are summed as
DECIMAL and cast to DOUBLE at the end; means are ``DOUBLE(exact sum) / count``;
statistics computed by different float algorithms are rounded to 6 places.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.literals import ts_lit
from tidemark.operators import aggregates as agg
from tidemark.operators import joins as jn
from tidemark.operators import snapshots as snap
from tidemark.operators import windows as win
from tidemark.plans.snapshot import EMERGE_CTE, GOLD_SELECT
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


def dec(c):
    return F.col(c).cast("decimal(12,2)")


def dsum(c, out):
    """Exact sum of a 2-decimal amount, reported as DOUBLE."""
    return F.sum(dec(c)).cast("double").alias(out)


def dmean(c, out):
    return (F.sum(dec(c)).cast("double") / F.count(c)).alias(out)


DSUM = "CAST(sum(CAST({c} AS DECIMAL(12,2))) AS DOUBLE)"
DMEAN = "(CAST(sum(CAST({c} AS DECIMAL(12,2))) AS DOUBLE) / count({c}))"


def T(spark, sf_dir):
    return tables(spark, sf_dir)


# ====================================================================== P

@register("project", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def q_project(spark, d):
    return T(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_quantity")


@register("filter_rows", """
SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_returnflag = 'R'""")
def q_filter_rows(spark, d):
    return (T(spark, d).lineitem
            .where((F.col("l_shipdate") >= ts_lit(dt.datetime(1998, 1, 1))) & (F.col("l_returnflag") == "R"))
            .select("l_orderkey", "l_linenumber", "l_shipdate"))


@register("derive_columns", """
SELECT l_orderkey AS order_id, l_linenumber,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(12,2))) AS DOUBLE) AS net_price,
       CAST(year(l_shipdate) AS INTEGER) AS ship_year, 'lineitem' AS source
FROM lineitem""")
def q_derive_columns(spark, d):
    return (T(spark, d).lineitem
            .withColumnRenamed("l_orderkey", "order_id")
            .withColumns({"net_price": (dec("l_extendedprice") * (F.lit(1) - dec("l_discount"))).cast("double"),
                          "ship_year": F.year("l_shipdate"),
                          "source": F.lit("lineitem")})
            .drop("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                  "l_returnflag", "l_linestatus", "l_shipdate"))


@register("case_buckets", """
SELECT event_type,
       CASE WHEN value < 10 THEN 'low' WHEN value < 100 THEN 'mid' ELSE 'high' END AS band,
       count(*) AS n_events
FROM events GROUP BY ALL""")
def q_case_buckets(spark, d):
    band = F.when(F.col("value") < 10, "low").when(F.col("value") < 100, "mid").otherwise("high")
    return T(spark, d).events.groupBy("event_type", band.alias("band")).agg(F.count(F.lit(1)).alias("n_events"))


@register("predicate_mix", """
SELECT c_custkey, c_name FROM customer
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_acctbal BETWEEN 1000 AND 5000
  AND c_name LIKE 'Customer#%0%' AND regexp_matches(c_name, '[13579]$') AND c_nationkey IS NOT NULL""")
def q_predicate_mix(spark, d):
    c = T(spark, d).customer
    return c.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
                   & F.col("c_acctbal").between(1000, 5000)
                   & F.col("c_name").like("Customer#%0%")
                   & F.col("c_name").rlike("[13579]$")
                   & F.col("c_nationkey").isNotNull()).select("c_custkey", "c_name")


@register("map_filter", """
SELECT l_linenumber * 2 AS doubled, count(*) AS n FROM lineitem WHERE l_linenumber * 2 > 5 GROUP BY 1""")
def q_map_filter(spark, d):
    return (T(spark, d).lineitem.select((F.col("l_linenumber") * 2).alias("doubled"))
            .where(F.col("doubled") > 5).groupBy("doubled").agg(F.count(F.lit(1)).alias("n")))


@register("explode_words", """
SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word""")
def q_explode_words(spark, d):
    return (T(spark, d).documents.select(F.explode(F.split("text", " ")).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


@register("parameterized_report", """
SELECT event_type, count(*) AS n_events, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total_value
FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-22' AND value >= 5
GROUP BY event_type""")
def q_parameterized_report(spark, d):
    return spark.sql(
        "SELECT event_type, count(*) AS n_events, "
        "CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total_value "
        "FROM {ev} WHERE ts >= CAST(:start AS TIMESTAMP_NTZ) AND ts < CAST(:end AS TIMESTAMP_NTZ) "
        "AND value >= :min_amount GROUP BY event_type",
        args={"start": "2024-01-08 00:00:00", "end": "2024-01-22 00:00:00", "min_amount": 5},
        ev=T(spark, d).events)


@register("subquery_from", """
SELECT count(*) AS n_users, CAST(sum(n) AS DOUBLE) / count(*) AS avg_events_per_user, max(n) AS max_events
FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)""")
def q_subquery_from(spark, d):
    per = T(spark, d).events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.count(F.lit(1)).alias("n_users"),
                   (F.sum("n").cast("double") / F.count(F.lit(1))).alias("avg_events_per_user"),
                   F.max("n").alias("max_events"))


CTE_SQL = """
WITH daily AS (SELECT CAST(ts AS DATE) AS day, user_id, count(*) AS n FROM {ev} GROUP BY 1, 2),
     busy AS (SELECT day, count(*) AS busy_users FROM daily WHERE n >= 3 GROUP BY day)
SELECT day, busy_users FROM busy"""


@register("cte_two_step", CTE_SQL.replace("{ev}", "events"))
def q_cte_two_step(spark, d):
    return spark.sql(CTE_SQL, ev=T(spark, d).events)


# ====================================================================== J

@register("join_inner", """
SELECT o.o_orderpriority, count(*) AS n_lines, CAST(sum(CAST(l.l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS total_qty
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderpriority""")
def q_join_inner(spark, d):
    t = T(spark, d)
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_lines"), dsum("l_quantity", "total_qty"))


@register("join_left", """
SELECT c.c_custkey, count(o.o_orderkey) AS n_orders
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY c.c_custkey""")
def q_join_left(spark, d):
    t = T(spark, d)
    o = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("_n"))
    # pre-aggregate the fact side, then a one-to-one left join
    return (t.customer.select("c_custkey")
            .join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
            .select("c_custkey", F.coalesce("_n", F.lit(0)).alias("n_orders")))


@register("join_broadcast", """
SELECT n.n_name, count(*) AS n_customers, CAST(sum(CAST(c.c_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS total_balance
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name""")
def q_join_broadcast(spark, d):
    t = T(spark, d)
    # nation has a fixed 25 rows: the broadcast is size-bounded by definition
    j = jn.lookup_join(t.customer, t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_name").agg(F.count(F.lit(1)).alias("n_customers"), dsum("c_acctbal", "total_balance"))


@register("join_range", """
WITH b AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders),
ranges AS (
  SELECT CAST(q AS DATE) AS q_start, CAST(last_day(q + INTERVAL 2 MONTH) AS DATE) AS q_end
  FROM (SELECT unnest(generate_series(date_trunc('quarter', lo), date_trunc('quarter', hi), INTERVAL 3 MONTH)) AS q FROM b))
SELECT r.q_start, r.q_end, count(*) AS n_orders,
       CAST(sum(CAST(o.o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total_price
FROM orders o JOIN ranges r ON CAST(o.o_orderdate AS DATE) BETWEEN r.q_start AND r.q_end
GROUP BY r.q_start, r.q_end""")
def q_join_range(spark, d):
    o = T(spark, d).orders.withColumn("od", F.to_date("o_orderdate"))
    b = o.agg(F.trunc(F.min("od"), "quarter").alias("lo"), F.trunc(F.max("od"), "quarter").alias("hi"))
    ranges = (b.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 3 MONTH"))).alias("q_start"))
              .withColumn("q_end", F.last_day(F.add_months("q_start", 2))))
    j = jn.range_join(o, ranges, "od", "q_start", "q_end", unit="month")
    return j.groupBy("q_start", "q_end").agg(F.count(F.lit(1)).alias("n_orders"),
                                             dsum("o_totalprice", "total_price"))


@register("join_preagg", """
SELECT c.c_custkey, c.c_name, o.order_total
FROM (SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING') c
JOIN (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS order_total
      FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' GROUP BY o_custkey) o
  ON c.c_custkey = o.o_custkey""")
def q_join_preagg(spark, d):
    t = T(spark, d)
    c = t.customer.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")
    o = (t.orders.where(F.col("o_orderdate") >= ts_lit(dt.datetime(1997, 1, 1)))
         .groupBy("o_custkey").agg(dsum("o_totalprice", "order_total")))
    return c.join(o, F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "c_name", "order_total")


@register("join_cross_stats", """
WITH s AS (SELECT CAST(sum(CAST(c_acctbal AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS mu,
                  stddev_samp(c_acctbal) AS sd FROM customer)
SELECT c_custkey, round((c_acctbal - mu) / sd, 6) AS z_score, abs((c_acctbal - mu) / sd) > 2 AS is_outlier
FROM customer, s""")
def q_join_cross_stats(spark, d):
    c = T(spark, d).customer
    s = jn.with_global_stats(c, {"mu": F.sum(dec("c_acctbal")).cast("double") / F.count(F.lit(1)),
                                 "sd": F.stddev_samp("c_acctbal")})
    z = (F.col("c_acctbal") - F.col("mu")) / F.col("sd")
    return s.select("c_custkey", F.round(z, 6).alias("z_score"), (F.abs(z) > 2).alias("is_outlier"))


@register("join_multiway", """
SELECT r.r_name,
       CAST(sum(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(12,2)))) AS DOUBLE) AS revenue
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY r.r_name""")
def q_join_multiway(spark, d):
    t = T(spark, d)
    geo = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))  # 25 rows, fixed
    cust = jn.lookup_join(t.customer.select("c_custkey", "c_nationkey"), geo,
                          F.col("c_nationkey") == F.col("n_nationkey"))
    j = (t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
         .join(cust, F.col("o_custkey") == F.col("c_custkey")))
    return j.groupBy("r_name").agg(
        F.sum(dec("l_extendedprice") * (F.lit(1) - dec("l_discount"))).cast("double").alias("revenue"))


@register("conform_codes", """
WITH lk AS (SELECT DISTINCT CAST(p_size AS BIGINT) AS code, p_size % 10 AS grp FROM part),
     rep AS (SELECT grp, min(code) AS rep FROM lk GROUP BY grp)
SELECT p.p_partkey, CAST(p.p_size AS BIGINT) AS p_size_raw, rep.rep AS PRIMARY_CAUSE_OF_LOSS_SK
FROM part p LEFT JOIN lk ON CAST(p.p_size AS BIGINT) = lk.code LEFT JOIN rep ON lk.grp = rep.grp""")
def q_conform_codes(spark, d):
    t = T(spark, d)
    p = t.part.select("p_partkey", F.col("p_size").cast("bigint").alias("PRIMARY_CAUSE_OF_LOSS_SK"),
                      F.col("p_size").cast("bigint").alias("p_size_raw"))
    return snap.conform(p, "PRIMARY_CAUSE_OF_LOSS_SK", t.cause_lookup(), "CAUSE_TYPE")


@register("rejoin_keys", EMERGE_CTE + "\n" + GOLD_SELECT.format(t="mom_p"))
def q_rejoin_keys(spark, d):
    from tidemark.plans.snapshot import _bronze
    aggp = snap.silver_aggregate(_bronze(spark, d), True, "latest")
    keys = ["QUARTER_END", "PRIMARY_CAUSE_OF_LOSS_SK", "AOP_SK"]
    mom = snap.silver_emergence(aggp, True)
    return snap.money_to_double(mom.drop("LOB_SK", "CLAIMANT_TYPE_SK")
                                .join(aggp.select(*keys, "LOB_SK", "CLAIMANT_TYPE_SK"), on=keys, how="left")
                                .select(*snap.GOLD_COLUMNS))


@register("join_left_anti", """
SELECT o_orderkey, o_orderstatus FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def q_join_left_anti(spark, d):
    t = T(spark, d)
    # orders with no line at all: source rows whose key is absent from the target
    return t.orders.join(t.lineitem.select("l_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"),
                         "left_anti").select("o_orderkey", "o_orderstatus")


def _user_window_state(ev, lo, hi):
    return (ev.where((F.col("ts") >= ts_lit(lo)) & (F.col("ts") < ts_lit(hi)))
            .groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"), F.sum(dec("value")).alias("total_value")))


STATE_SQL = """
b AS (SELECT user_id, count(*) AS n_events, sum(CAST(value AS DECIMAL(12,2))) AS total_value FROM events
      WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-20' GROUP BY user_id),
a AS (SELECT user_id, count(*) AS n_events, sum(CAST(value AS DECIMAL(12,2))) AS total_value FROM events
      WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-31' GROUP BY user_id)"""


@register("table_diff", "WITH " + STATE_SQL + """
SELECT coalesce(b.user_id, a.user_id) AS user_id,
       CASE WHEN b.user_id IS NULL THEN 'insert' WHEN a.user_id IS NULL THEN 'delete'
            WHEN b.n_events IS NOT DISTINCT FROM a.n_events AND b.total_value IS NOT DISTINCT FROM a.total_value
            THEN 'same' ELSE 'update' END AS change,
       b.n_events AS before_n, a.n_events AS after_n
FROM b FULL OUTER JOIN a ON b.user_id = a.user_id""")
def q_table_diff(spark, d):
    ev = T(spark, d).events
    b = _user_window_state(ev, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 20))
    a = _user_window_state(ev, dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 31))
    c = jn.compare_by_key(b, a, ["user_id"])
    return c.select("user_id", F.col("_diff").alias("change"),
                    F.col("_b_n_events").alias("before_n"), F.col("_a_n_events").alias("after_n"))


@register("join_asof", """
SELECT p.event_id, p.user_id, p.ts, v.value AS last_view_value
FROM (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT user_id, ts, value FROM events WHERE event_type = 'view') v
  ON p.user_id = v.user_id AND p.ts >= v.ts""")
def q_join_asof(spark, d):
    ev = T(spark, d).events
    p = ev.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    v = ev.where(F.col("event_type") == "view").select("user_id", F.col("ts").alias("vts"), "value", "event_id")
    out = jn.asof_join(p, v, ["user_id"], "ts", "vts", ["value"], tiebreak="event_id")
    return out.withColumnRenamed("value", "last_view_value")


@register("lineage_impact", """
WITH RECURSIVE edges AS (SELECT CAST(floor(c_custkey / 2) AS BIGINT) AS src, CAST(c_custkey AS BIGINT) AS dst
                         FROM customer WHERE c_custkey >= 2),
walk(node, lvl) AS (
  SELECT dst, 1 FROM edges WHERE src = 1
  UNION ALL
  SELECT e.dst, w.lvl + 1 FROM walk w JOIN edges e ON e.src = w.node WHERE w.lvl < 5)
SELECT node, min(lvl) AS min_level, count(*) AS n_paths FROM walk GROUP BY node""")
def q_lineage_impact(spark, d):
    return jn.reachable(T(spark, d).lineage_edges(), root=1, max_level=5)


@register("model_error_join", """
WITH pred AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS predicted FROM lineitem GROUP BY l_orderkey),
j AS (SELECT o.o_orderpriority, p.predicted - CAST(o.o_totalprice AS DECIMAL(12,2)) AS err
      FROM pred p JOIN orders o ON p.l_orderkey = o.o_orderkey)
SELECT o_orderpriority, count(*) AS n, CAST(sum(abs(err)) AS DOUBLE) / count(*) AS mae,
       CAST(sum(err) AS DOUBLE) / count(*) AS bias, sqrt(CAST(sum(err * err) AS DOUBLE) / count(*)) AS rmse
FROM j GROUP BY o_orderpriority""")
def q_model_error_join(spark, d):
    t = T(spark, d)
    pred = t.lineitem.groupBy("l_orderkey").agg(F.sum(dec("l_extendedprice")).alias("predicted"))
    j = pred.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")) \
        .select("o_orderpriority", (F.col("predicted") - dec("o_totalprice")).alias("err"))
    n = F.count(F.lit(1))
    return j.groupBy("o_orderpriority").agg(
        n.alias("n"), (F.sum(F.abs("err")).cast("double") / n).alias("mae"),
        (F.sum("err").cast("double") / n).alias("bias"),
        F.sqrt(F.sum(F.col("err") * F.col("err")).cast("double") / n).alias("rmse"))


# ====================================================================== A

@register("agg_count", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def q_agg_count(spark, d):
    return T(spark, d).events.groupBy("event_type").count().withColumnRenamed("count", "n")


@register("agg_multi", """
SELECT l_returnflag, l_linestatus, count(*) AS n_lines,
       round(CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) / count(*), 2) AS avg_qty,
       max(l_extendedprice) AS max_price, list_sort(list_distinct(list(l_linenumber))) AS line_numbers
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def q_agg_multi(spark, d):
    return T(spark, d).lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.round(F.sum(dec("l_quantity")).cast("double") / F.count(F.lit(1)), 2).alias("avg_qty"),
        F.max("l_extendedprice").alias("max_price"),
        # a set over a bounded domain (line numbers), never an unbounded list
        F.array_sort(F.collect_set("l_linenumber")).alias("line_numbers"))


@register("agg_conditional", """
SELECT user_id, count(*) FILTER (WHERE event_type = 'error') AS n_errors,
       CAST(coalesce(sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(12,2)) END), 0) AS DOUBLE) AS purchase_value,
       CAST(sum(CASE WHEN value > 100 THEN 1 ELSE 0 END) AS BIGINT) AS n_large
FROM events GROUP BY user_id""")
def q_agg_conditional(spark, d):
    ev = T(spark, d).events
    return ev.groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "error").alias("n_errors"),
        F.coalesce(F.sum(F.when(F.col("event_type") == "purchase", dec("value"))), F.lit(0)).cast("double")
        .alias("purchase_value"),
        F.sum(F.when(F.col("value") > 100, 1).otherwise(0)).cast("bigint").alias("n_large"))


@register("agg_distinct", """
SELECT event_type, count(DISTINCT user_id) AS n_users, count(DISTINCT CAST(ts AS DATE)) AS n_days
FROM events GROUP BY event_type""")
def q_agg_distinct(spark, d):
    return T(spark, d).events.groupBy("event_type").agg(
        F.count_distinct("user_id").alias("n_users"), F.count_distinct(F.to_date("ts")).alias("n_days"))


@register("agg_percentiles", """
SELECT event_type, round(quantile_cont(value, 0.5), 6) AS median_value, round(quantile_cont(value, 0.95), 6) AS p95_value,
       round(stddev_samp(value), 6) AS stddev_value,
       CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / count(value) AS avg_value
FROM events GROUP BY event_type""")
def q_agg_percentiles(spark, d):
    ev = T(spark, d).events
    p = agg.exact_percentiles(ev, "value", ["event_type"], {"median_value": 0.5, "p95_value": 0.95})
    s = ev.groupBy("event_type").agg(F.round(F.stddev_samp("value"), 6).alias("stddev_value"),
                                     dmean("value", "avg_value"))
    return (p.join(s, "event_type")
            .select("event_type", F.round("median_value", 6).alias("median_value"),
                    F.round("p95_value", 6).alias("p95_value"), "stddev_value", "avg_value"))


@register("agg_regression", """
SELECT l_returnflag, round(corr(l_extendedprice, l_quantity), 6) AS correlation,
       round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept
FROM lineitem GROUP BY l_returnflag""")
def q_agg_regression(spark, d):
    return T(spark, d).lineitem.groupBy("l_returnflag").agg(
        F.round(F.corr("l_extendedprice", "l_quantity"), 6).alias("correlation"),
        F.round(F.regr_slope("l_extendedprice", "l_quantity"), 6).alias("slope"),
        F.round(F.regr_intercept("l_extendedprice", "l_quantity"), 6).alias("intercept"))


@register("agg_having", """
SELECT user_id, count(*) AS n_events FROM events GROUP BY user_id HAVING n_events > 70""")
def q_agg_having(spark, d):
    return spark.sql("SELECT user_id, count(*) AS n_events FROM {ev} GROUP BY user_id HAVING n_events > 70",
                     ev=T(spark, d).events)


@register("agg_global", """
SELECT count(*) AS n_lines, CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS total_qty,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS avg_price,
       min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
FROM lineitem""")
def q_agg_global(spark, d):
    return T(spark, d).lineitem.agg(
        F.count(F.lit(1)).alias("n_lines"), dsum("l_quantity", "total_qty"),
        dmean("l_extendedprice", "avg_price"), F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"))


@register("daily_summary", """
SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n_events,
       CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total_value,
       CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / count(value) AS avg_value
FROM events GROUP BY 1, 2""")
def q_daily_summary(spark, d):
    return T(spark, d).events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("n_events"), dsum("value", "total_value"), dmean("value", "avg_value"))


PROFILE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("profile_table", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max "
    f"FROM lineitem" for c in PROFILE_COLS))
def q_profile_table(spark, d):
    p = agg.profile(T(spark, d).lineitem, PROFILE_COLS)
    return p.withColumns({"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)})


@register("dedupe_keyed", """
SELECT user_id, event_id, ts, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def q_dedupe_keyed(spark, d):
    ev = T(spark, d).events
    return snap.dedupe_keyed(ev, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()]) \
        .select("user_id", "event_id", "ts", "event_type")


@register("duplicate_ratio", """
SELECT count(*) AS total_rows, count(DISTINCT text) AS distinct_rows,
       1.0 - CAST(count(DISTINCT text) AS DOUBLE) / count(*) AS duplicate_ratio FROM documents""")
def q_duplicate_ratio(spark, d):
    return agg.duplicate_ratio(T(spark, d).documents, ["text"])


@register("compliance_summary", """
SELECT 'total_events' AS metric, CAST(count(*) AS DOUBLE) AS value FROM events
UNION ALL SELECT 'error_events', CAST(count(*) FILTER (WHERE event_type = 'error') AS DOUBLE) FROM events
UNION ALL SELECT 'distinct_users', CAST(count(DISTINCT user_id) AS DOUBLE) FROM events
UNION ALL SELECT 'purchase_value', CAST(sum(CAST(value AS DECIMAL(12,2))) FILTER (WHERE event_type = 'purchase') AS DOUBLE) FROM events""")
def q_compliance_summary(spark, d):
    ev = T(spark, d).events
    return agg.metrics_long(ev, {
        "total_events": F.count(F.lit(1)),
        "error_events": F.count_if(F.col("event_type") == "error"),
        "distinct_users": F.count_distinct("user_id"),
        "purchase_value": F.sum(F.when(F.col("event_type") == "purchase", dec("value"))),
    })


@register("access_summary", """
SELECT user_id, event_type, count(*) AS n_access, count(DISTINCT CAST(ts AS DATE)) AS n_days,
       min(ts) AS first_access, max(ts) AS last_access
FROM events GROUP BY user_id, event_type HAVING count(*) > 15""")
def q_access_summary(spark, d):
    return (T(spark, d).events.groupBy("user_id", "event_type")
            .agg(F.count(F.lit(1)).alias("n_access"), F.count_distinct(F.to_date("ts")).alias("n_days"),
                 F.min("ts").alias("first_access"), F.max("ts").alias("last_access"))
            .where(F.col("n_access") > 15))


@register("cost_breakdown", """
WITH daily AS (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n_events,
                      sum(CAST(value AS DECIMAL(12,2))) AS total FROM events GROUP BY 1, 2)
SELECT day, event_type, n_events, CAST(total AS DOUBLE) AS total_cost,
       CAST(sum(total) OVER (PARTITION BY event_type) AS DOUBLE) / count(*) OVER (PARTITION BY event_type)
         AS type_avg_daily_cost
FROM daily""")
def q_cost_breakdown(spark, d):
    daily = (T(spark, d).events.groupBy(F.to_date("ts").alias("day"), "event_type")
             .agg(F.count(F.lit(1)).alias("n_events"), F.sum(dec("value")).alias("total")))
    w = Window.partitionBy("event_type")
    return daily.select("day", "event_type", "n_events", F.col("total").cast("double").alias("total_cost"),
                        (F.sum("total").over(w).cast("double") / F.count(F.lit(1)).over(w))
                        .alias("type_avg_daily_cost"))


# ====================================================================== W

@register("win_row_number", """
SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events""")
def q_win_row_number(spark, d):
    ev = T(spark, d).events.select("event_id", "user_id", "ts")
    # per (user, day) plus the counts of the user's earlier days: a hot user is split by day
    out = win.row_numbers(ev, ["user_id"], ["ts", "event_id"], "rn", bucket=F.to_date("ts"))
    return out.select("event_id", "user_id", F.col("rn").cast("bigint").alias("rn"))


@register("win_ranks", """
SELECT c_custkey, rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS nation_rank,
       dense_rank() OVER (ORDER BY c_acctbal DESC) AS overall_rank,
       rank() OVER (ORDER BY c_acctbal DESC) AS overall_rank_gaps
FROM customer""")
def q_win_ranks(spark, d):
    c = T(spark, d).customer
    # within-nation rank by the same range-partition + offsets plan: a nation
    # holding most customers is spread over several tasks
    c = win.global_rank(c, "c_acctbal", descending=True, out="nation_rank", by=["c_nationkey"])
    c = c.withColumn("nation_rank", F.col("nation_rank").cast("bigint"))
    c = win.global_rank(c, "c_acctbal", descending=True, dense=True, out="overall_rank")
    c = win.global_rank(c, "c_acctbal", descending=True, dense=False, out="overall_rank_gaps")
    return c.select("c_custkey", "nation_rank", F.col("overall_rank").cast("bigint").alias("overall_rank"),
                    F.col("overall_rank_gaps").cast("bigint").alias("overall_rank_gaps"))


@register("win_running_range", """
SELECT event_id, user_id,
       CAST(sum(CAST(value AS DECIMAL(12,2))) OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE)) AS DOUBLE) AS running_total
FROM events""")
def q_win_running_range(spark, d):
    ev = T(spark, d).events.withColumns({"day": F.to_date("ts"), "v": dec("value")})
    # per (user, week) plus the totals of the user's earlier weeks; ties (one
    # day) never straddle a week, so the RANGE frame is unchanged
    out = win.running_sum(ev, ["user_id"], ["day"], "v", "running_total", bucket=F.date_trunc("week", "day"))
    return out.select("event_id", "user_id", F.col("running_total").cast("double").alias("running_total"))


DAILY_SQL = "daily AS (SELECT CAST(ts AS DATE) AS day, sum(CAST(value AS DECIMAL(12,2))) AS total FROM events GROUP BY 1)"


def _daily_totals(spark, d):
    return T(spark, d).events.groupBy(F.to_date("ts").alias("day")).agg(F.sum(dec("value")).alias("total"))


@register("win_running_rows", "WITH " + DAILY_SQL + """
SELECT day, CAST(total AS DOUBLE) AS total,
       CAST(sum(total) OVER (ORDER BY day ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_total FROM daily""")
def q_win_running_rows(spark, d):
    # the global window runs over the day grain (bounded by the calendar)
    out = win.running_sum(_daily_totals(spark, d), [], ["day"], "total", "running_total", rows=True)
    return out.select("day", F.col("total").cast("double").alias("total"),
                      F.col("running_total").cast("double").alias("running_total"))


@register("win_moving_avg", "WITH " + DAILY_SQL + """
SELECT day, CAST(sum(total) OVER w AS DOUBLE) / count(*) OVER w AS avg_7
FROM daily WINDOW w AS (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def q_win_moving_avg(spark, d):
    w = Window.orderBy("day").rowsBetween(-6, 0)
    return _daily_totals(spark, d).select(
        "day", (F.sum("total").over(w).cast("double") / F.count(F.lit(1)).over(w)).alias("avg_7"))


@register("win_lag_diff", """
WITH daily AS (SELECT CAST(ts AS DATE) AS day, event_type, sum(CAST(value AS DECIMAL(12,2))) AS total FROM events GROUP BY 1, 2)
SELECT day, event_type, CAST(total AS DOUBLE) AS total,
       CAST(total - lag(total) OVER (PARTITION BY event_type ORDER BY day) AS DOUBLE) AS total_change
FROM daily""")
def q_win_lag_diff(spark, d):
    daily = (T(spark, d).events.groupBy(F.to_date("ts").alias("day"), "event_type")
             .agg(F.sum(dec("value")).alias("total")))
    out = win.lag_change(daily, ["event_type"], ["day"], ["total"])
    return out.select("day", "event_type", F.col("total").cast("double").alias("total"),
                      F.col("total_change").cast("double").alias("total_change"))


@register("mae_change", """
WITH daily AS (SELECT CAST(ts AS DATE) AS day,
                      CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS mae
               FROM events WHERE event_type = 'error' GROUP BY 1)
SELECT day, mae, lag(mae) OVER (ORDER BY day) AS prev_mae,
       (mae - lag(mae) OVER (ORDER BY day)) / lag(mae) OVER (ORDER BY day) AS mae_change
FROM daily""")
def q_mae_change(spark, d):
    daily = (T(spark, d).events.where(F.col("event_type") == "error")
             .groupBy(F.to_date("ts").alias("day")).agg(dmean("value", "mae")))
    out = win.lag_change(daily, [], ["day"], ["mae"], ratio=True)
    return out.select("day", "mae", "prev_mae", "mae_change")


@register("win_prior_avg", """
SELECT event_id, user_id,
       CAST(sum(CAST(value AS DECIMAL(12,2))) OVER w AS DOUBLE) / count(value) OVER w AS prior_avg
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)""")
def q_win_prior_avg(spark, d):
    ev = T(spark, d).events.select("event_id", "user_id", "ts", dec("value").alias("v"))
    # per (user, day) with the previous rows of earlier days as halo: a hot user is split by day
    p = win.prior_rows(ev, ["user_id"], ["ts", "event_id"], "v", 10, bucket=F.to_date("ts"))
    return p.select("event_id", "user_id", (F.col("_prior_sum").cast("double") / F.col("_prior_cnt"))
                    .alias("prior_avg"))


@register("slow_vs_history", """
SELECT event_id, user_id, value, prior_avg FROM (
  SELECT event_id, user_id, value,
         CAST(sum(CAST(value AS DECIMAL(12,2))) OVER w AS DOUBLE) / count(value) OVER w AS prior_avg
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING))
WHERE value > 1.5 * prior_avg""")
def q_slow_vs_history(spark, d):
    ev = T(spark, d).events.select("event_id", "user_id", "ts", "value", dec("value").alias("v"))
    p = win.prior_rows(ev, ["user_id"], ["ts", "event_id"], "v", 10, bucket=F.to_date("ts"))
    s = p.select("event_id", "user_id", "value",
                 (F.col("_prior_sum").cast("double") / F.col("_prior_cnt")).alias("prior_avg"))
    return s.where(F.col("value") > F.lit(1.5) * F.col("prior_avg"))


@register("topn_per_group", """
SELECT o_custkey, o_orderkey, o_totalprice, rn FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
WHERE rn <= 3""")
def q_topn_per_group(spark, d):
    o = T(spark, d).orders.select("o_custkey", "o_orderkey", "o_totalprice")
    out = win.top_n_per_group(o, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 3)
    return out.withColumn("rn", F.col("rn").cast("bigint"))


# ====================================================================== O

@register("sort_multi", """
SELECT l_returnflag, l_shipdate, l_orderkey, l_linenumber FROM lineitem
ORDER BY l_returnflag, l_shipdate DESC, l_orderkey, l_linenumber""")
def q_sort_multi(spark, d):
    return (T(spark, d).lineitem.select("l_returnflag", "l_shipdate", "l_orderkey", "l_linenumber")
            .orderBy("l_returnflag", F.col("l_shipdate").desc(), "l_orderkey", "l_linenumber"))


@register("top_k", """
SELECT event_id, user_id, value FROM events ORDER BY value DESC, event_id LIMIT 10""")
def q_top_k(spark, d):
    return (T(spark, d).events.select("event_id", "user_id", "value")
            .orderBy(F.col("value").desc(), "event_id").limit(10))


@register("union_all", """
SELECT c_nationkey AS nationkey, 'customer' AS kind FROM customer
UNION ALL SELECT s_nationkey, 'supplier' FROM supplier""")
def q_union_all(spark, d):
    t = T(spark, d)
    return (t.customer.select(F.col("c_nationkey").alias("nationkey"), F.lit("customer").alias("kind"))
            .union(t.supplier.select(F.col("s_nationkey").alias("nationkey"), F.lit("supplier").alias("kind"))))


@register("union_by_name", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""")
def q_union_by_name(spark, d):
    t = T(spark, d)
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                          F.col("c_acctbal").alias("balance"))
    b = t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"),
                          F.col("s_suppkey").alias("id"))
    return a.unionByName(b)


@register("union_distinct", """
SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier""")
def q_union_distinct(spark, d):
    t = T(spark, d)
    return (t.customer.select(F.col("c_nationkey").alias("nationkey"))
            .unionByName(t.supplier.select(F.col("s_nationkey").alias("nationkey"))).distinct())


# ====================================================================== F

@register("fn_date_parts", """
SELECT d, CAST(date_trunc('month', d) AS DATE) AS month_start, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(year(d) AS INTEGER) AS yr, CAST(month(d) AS INTEGER) AS mon, CAST(dayofweek(d) + 1 AS INTEGER) AS dow
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)""")
def q_fn_date_parts(spark, d):
    o = T(spark, d).orders.select(F.to_date("o_orderdate").alias("d")).distinct()
    return o.select("d", F.trunc("d", "month").alias("month_start"), F.quarter("d").alias("quarter"),
                    F.year("d").alias("yr"), F.month("d").alias("mon"), F.dayofweek("d").alias("dow"))


@register("fn_event_hours", """
SELECT CAST(hour(ts) AS INTEGER) AS hr, count(*) AS n FROM events GROUP BY 1""")
def q_fn_event_hours(spark, d):
    return T(spark, d).events.groupBy(F.hour("ts").alias("hr")).agg(F.count(F.lit(1)).alias("n"))


@register("fn_date_arith", """
SELECT event_id, CAST(CAST(ts AS DATE) + INTERVAL 30 DAY AS DATE) AS due_date,
       CAST(date_diff('day', CAST(ts AS DATE), DATE '2024-02-01') AS INTEGER) AS days_left,
       date_sub('hour', ts, TIMESTAMP '2024-02-01') AS hours_left
FROM events""")
def q_fn_date_arith(spark, d):
    ev = T(spark, d).events
    return ev.select("event_id", F.date_add(F.to_date("ts"), 30).alias("due_date"),
                     F.datediff(F.lit(dt.date(2024, 2, 1)), F.to_date("ts")).alias("days_left"),
                     F.expr("timestampdiff(HOUR, ts, TIMESTAMP_NTZ'2024-02-01 00:00:00')").alias("hours_left"))


@register("fn_calendar", """
SELECT d, last_day(d) AS month_end, CAST(date_trunc('quarter', d) AS DATE) AS quarter_start,
       CAST(strptime(strftime(d, '%Y%m%d'), '%Y%m%d') AS DATE) AS reparsed
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)""")
def q_fn_calendar(spark, d):
    o = T(spark, d).orders.select(F.to_date("o_orderdate").alias("d")).distinct()
    return o.select("d", F.last_day("d").alias("month_end"), F.trunc("d", "quarter").alias("quarter_start"),
                    F.to_date(F.date_format("d", "yyyyMMdd"), "yyyyMMdd").alias("reparsed"))


@register("fn_date_format", """
SELECT d, strftime(d, '%A') AS day_name FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)""")
def q_fn_date_format(spark, d):
    o = T(spark, d).orders.select(F.to_date("o_orderdate").alias("d")).distinct()
    return o.select("d", F.date_format("d", "EEEE").alias("day_name"))


@register("fn_timezone", """
SELECT event_id, timezone('America/New_York', timezone('UTC', ts)) AS ts_new_york,
       timezone('Europe/London', timezone('UTC', ts)) AS ts_london
FROM events""")
def q_fn_timezone(spark, d):
    ev = T(spark, d).events
    return ev.select("event_id",
                     F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), "ts").alias("ts_new_york"),
                     F.convert_timezone(F.lit("UTC"), F.lit("Europe/London"), "ts").alias("ts_london"))


@register("fn_array", """
SELECT doc_id, len(string_split(text, ' ')) AS n_tokens,
       list_contains(string_split(text, ' '), 'the') AS has_the,
       len(list_filter(string_split(text, ' '), lambda x: x <> '')) AS n_nonempty
FROM documents""")
def q_fn_array(spark, d):
    words = F.split("text", " ")
    return T(spark, d).documents.select(
        "doc_id", F.size(words).alias("n_tokens"), F.array_contains(words, "the").alias("has_the"),
        F.size(F.filter(words, lambda x: x != "")).alias("n_nonempty"))


@register("fn_json", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CAST(json_array_length('[' || props || ']') AS INTEGER) AS n_items
FROM events""")
def q_fn_json(spark, d):
    ev = T(spark, d).events
    return ev.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"),
                     F.json_array_length(F.concat(F.lit("["), F.col("props"), F.lit("]"))).alias("n_items"))


@register("fn_variant", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def q_fn_variant(spark, d):
    ev = T(spark, d).events
    return ev.select("event_id", F.variant_get(F.parse_json("props"), "$.k", "int").alias("k"))


@register("fn_string", """
SELECT c_custkey, c_name || '-' || c_mktsegment AS label, left(c_mktsegment, 3) AS seg3,
       split_part(c_name, '#', 2) AS num_part, substring(c_name, 10, 9) AS sub,
       regexp_replace(c_name, '[0-9]', '', 'g') AS letters
FROM customer""")
def q_fn_string(spark, d):
    c = T(spark, d).customer
    return c.select("c_custkey", F.concat("c_name", F.lit("-"), "c_mktsegment").alias("label"),
                    F.left("c_mktsegment", F.lit(3)).alias("seg3"),
                    F.split("c_name", "#").getItem(1).alias("num_part"),
                    F.substring("c_name", 10, 9).alias("sub"),
                    F.regexp_replace("c_name", "[0-9]", "").alias("letters"))


@register("fn_hash", """
SELECT c_custkey, sha256(CAST(c_custkey AS VARCHAR)) AS key_sha256,
       CAST((instr('0123456789abcdef', substr(md5(CAST(c_custkey AS VARCHAR)), 1, 1)) - 1) % 2 AS INTEGER) AS bucket
FROM customer""")
def q_fn_hash(spark, d):
    c = T(spark, d).customer
    k = F.col("c_custkey").cast("string")
    return c.select("c_custkey", F.sha2(k, 256).alias("key_sha256"),
                    (F.conv(F.substring(F.md5(k), 1, 1), 16, 10).cast("int") % 2).alias("bucket"))


@register("fn_math", """
SELECT l_orderkey, l_linenumber,
       CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(12,2)), 2) AS DOUBLE) AS disc_amount,
       CAST(abs(CAST(l_extendedprice AS DECIMAL(12,2)) - 1000) AS DOUBLE) AS dist_1000,
       CASE WHEN l_discount = 0 THEN NULL ELSE l_tax / l_discount END AS tax_per_discount
FROM lineitem""")
def q_fn_math(spark, d):
    li = T(spark, d).lineitem
    return li.select("l_orderkey", "l_linenumber",
                     F.round(dec("l_extendedprice") * dec("l_discount"), 2).cast("double").alias("disc_amount"),
                     F.abs(dec("l_extendedprice") - F.lit(1000)).cast("double").alias("dist_1000"),
                     F.try_divide("l_tax", "l_discount").alias("tax_per_discount"))


@register("fn_cast", """
SELECT event_id, CAST(ts AS DATE) AS day, CAST(user_id AS VARCHAR) AS user_str,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, TRY_CAST(event_type AS INTEGER) AS bad
FROM events""")
def q_fn_cast(spark, d):
    ev = T(spark, d).events
    return ev.select("event_id", F.to_date("ts").alias("day"), F.col("user_id").cast("string").alias("user_str"),
                     F.get_json_object("props", "$.k").try_cast("int").alias("k"),
                     F.col("event_type").try_cast("int").alias("bad"))


@register("fn_struct", """
SELECT event_id, user_id AS s_user, event_type AS s_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM events""")
def q_fn_struct(spark, d):
    ev = T(spark, d).events
    s = ev.select("event_id", F.struct("user_id", "event_type").alias("s"),
                  F.from_json("props", "k INT").alias("data"))
    return s.select("event_id", F.col("s.user_id").alias("s_user"), F.col("s.event_type").alias("s_type"), "data.*")
