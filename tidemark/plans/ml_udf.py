"""Registered machine-learning (M) and UDF-surface (U) queries with oracle SQL.

Roles: ``events`` users are the modelled entities (value = amount, props.k a
score); order lines give a per-order prediction (sum of line totals) scored
against the order's recorded total.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import udfs
from tidemark.functions.literals import ts_lit
from tidemark.operators import ml
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


def dec(c):
    return F.col(c).cast("decimal(12,2)")


# ====================================================================== M

@register("feature_table", """
SELECT user_id, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / count(value) AS avg_value,
       count(*) AS n_events, max(ts) AS last_seen
FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-31' GROUP BY user_id""")
def q_feature_table(spark, d):
    return ml.feature_table(T(spark, d).events, "user_id", "ts", "value", dt.datetime(2024, 1, 31), 30)


@register("training_set", """
WITH f AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS day_events,
                  CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS day_value,
                  CAST(CAST(ts AS DATE) + INTERVAL 1 DAY AS TIMESTAMP) AS feature_ts
           FROM events GROUP BY user_id, CAST(ts AS DATE)),
l AS (SELECT event_id, user_id, ts, value AS label FROM events WHERE event_type = 'purchase')
SELECT l.event_id, l.user_id, l.ts, l.label, f.day_events, f.day_value
FROM l ASOF LEFT JOIN f ON l.user_id = f.user_id AND l.ts >= f.feature_ts""")
def q_training_set(spark, d):
    ev = T(spark, d).events
    feats = ml.daily_feature_snapshots(ev, "user_id", "ts", "value")
    labels = ev.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts",
                                                                 F.col("value").alias("label"))
    return ml.training_set(labels, feats, "user_id", "ts", "feature_ts", ["day_events", "day_value"])


def _order_features(t):
    per = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).cast("double").alias("n_lines"),
                                               F.sum("l_quantity").alias("total_qty"),
                                               F.avg("l_discount").alias("avg_discount"))
    return per.join(t.orders.select("o_orderkey", "o_totalprice"), F.col("l_orderkey") == F.col("o_orderkey"))


FEATURES = ["n_lines", "total_qty", "avg_discount"]


@register("train_forest")
def q_train_forest(spark, d):
    data = _order_features(T(spark, d))
    model = ml.train_forest(data, FEATURES, "o_totalprice", num_trees=100, seed=42)
    return ml.score(data, model, FEATURES).select("o_orderkey", "o_totalprice", "prediction")


def line_features(t):
    """Order features with fixed scales, whose sums are exact."""
    per = t.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("decimal(12,2)").alias("n_lines"), F.sum(dec("l_quantity")).cast("decimal(12,2)").alias("total_qty"),
        F.sum(dec("l_discount")).cast("decimal(12,2)").alias("total_discount"))
    return per.join(t.orders.select("o_orderkey", dec("o_totalprice").alias("o_totalprice")), F.col("l_orderkey") == F.col("o_orderkey"))


LINE_FEATURES = ["n_lines", "total_qty", "total_discount"]

# the normal equations of three centred features, by determinants
LINEAR_SQL = """lf AS (SELECT l_orderkey AS o_orderkey, count(*) AS a, sum(CAST(l_quantity AS DECIMAL(12,2))) AS b, sum(CAST(l_discount AS DECIMAL(12,2))) AS c
       FROM lineitem GROUP BY l_orderkey),
lx AS (SELECT o_orderkey, CAST(a AS DECIMAL(12,2)) AS a, CAST(b AS DECIMAL(12,2)) AS b, CAST(c AS DECIMAL(12,2)) AS c, CAST(o_totalprice AS DECIMAL(12,2)) AS y
       FROM lf JOIN orders USING (o_orderkey)),
ls AS (SELECT count(*)::DOUBLE AS n, sum(a)::DOUBLE AS a, sum(b)::DOUBLE AS b, sum(c)::DOUBLE AS c, sum(y)::DOUBLE AS y, sum(a*a)::DOUBLE AS aa, sum(a*b)::DOUBLE AS ab,
       sum(a*c)::DOUBLE AS ac, sum(b*b)::DOUBLE AS bb, sum(b*c)::DOUBLE AS bc, sum(c*c)::DOUBLE AS cc, sum(a*y)::DOUBLE AS ay, sum(b*y)::DOUBLE AS by_, sum(c*y)::DOUBLE AS cy, sum(y*y)::DOUBLE AS yy FROM lx),
lc AS (SELECT n, a/n AS ma, b/n AS mb, c/n AS mc, y/n AS my, aa-a*a/n AS aa, ab-a*b/n AS ab, ac-a*c/n AS ac, bb-b*b/n AS bb, bc-b*c/n AS bc, cc-c*c/n AS cc,
       ay-a*y/n AS ay, by_-b*y/n AS by_, cy-c*y/n AS cy, yy-y*y/n AS yy FROM ls),
ld AS (SELECT *, aa*(bb*cc-bc*bc) - ab*(ab*cc-bc*ac) + ac*(ab*bc-bb*ac) AS det FROM lc),
lw AS (SELECT *, (ay*(bb*cc-bc*bc) - ab*(by_*cc-bc*cy) + ac*(by_*bc-bb*cy)) / det AS wa, (aa*(by_*cc-bc*cy) - ay*(ab*cc-bc*ac) + ac*(ab*cy-by_*ac)) / det AS wb,
       (aa*(bb*cy-by_*bc) - ab*(ab*cy-by_*ac) + ay*(ab*bc-bb*ac)) / det AS wc FROM ld),
lm AS (SELECT *, my - wa*ma - wb*mb - wc*mc AS w0, greatest(yy - wa*ay - wb*by_ - wc*cy, 0) AS sse FROM lw)"""

SCORE_SQL = "WITH " + LINEAR_SQL + """
SELECT o_orderkey, round(w0 + lx.a::DOUBLE*wa + lx.b::DOUBLE*wb + lx.c::DOUBLE*wc, 4) AS prediction{more} FROM lx, lm"""


@register("train_linear", "WITH " + LINEAR_SQL + """
SELECT t.term, round(t.value, 4) AS value FROM lm, LATERAL (VALUES ('intercept', w0), ('n_lines', wa), ('total_qty', wb), ('total_discount', wc),
       ('n', n), ('rmse', sqrt(sse / n)), ('r2', 1 - sse / yy)) AS t(term, value)""")
def q_train_linear(spark, d):
    m = ml.fit_linear(line_features(T(spark, d)), LINE_FEATURES, "o_totalprice")
    terms = [("intercept", m.intercept), *zip(m.features, m.coefficients), ("n", float(m.n)), ("rmse", m.mse ** 0.5), ("r2", m.r2)]
    return spark.createDataFrame(terms, "term string, value double").withColumn("value", F.round("value", 4))


@register("batch_score", SCORE_SQL.format(more=""))
def q_batch_score(spark, d):
    data = line_features(T(spark, d))
    model = ml.fit_linear(data, LINE_FEATURES, "o_totalprice")
    return ml.score_linear(data, model).select("o_orderkey", F.round("prediction", 4).alias("prediction"))


PRED_SQL = """pred AS (
  SELECT l_orderkey,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(12,2)))
                  * (1 + CAST(l_tax AS DECIMAL(12,2)))) AS DECIMAL(18,2)) AS predicted
  FROM lineitem GROUP BY l_orderkey),
po AS (SELECT o.o_orderpriority, CAST(o.o_orderdate AS DATE) AS day, p.predicted,
              CAST(o.o_totalprice AS DECIMAL(18,2)) AS actual
       FROM pred p JOIN orders o ON p.l_orderkey = o.o_orderkey)"""


def _pred_actual(t):
    li = t.lineitem
    pred = li.groupBy("l_orderkey").agg(
        F.sum(dec("l_extendedprice") * (F.lit(1) - dec("l_discount")) * (F.lit(1) + dec("l_tax")))
        .cast("decimal(18,2)").alias("predicted"))
    return pred.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_orderpriority", F.to_date("o_orderdate").alias("day"), "predicted",
        F.col("o_totalprice").cast("decimal(18,2)").alias("actual"), "o_orderdate")


METRICS_SQL = """count(*) AS n, CAST(sum(abs(predicted - actual)) AS DOUBLE) / count(*) AS mae,
       CAST(sum((predicted - actual) * (predicted - actual)) AS DOUBLE) / count(*) AS mse,
       sqrt(CAST(sum((predicted - actual) * (predicted - actual)) AS DOUBLE) / count(*)) AS rmse,
       1.0 - CAST(sum((predicted - actual) * (predicted - actual)) AS DOUBLE)
             / (CAST(sum(actual * actual) AS DOUBLE) - CAST(sum(actual) AS DOUBLE) * CAST(sum(actual) AS DOUBLE) / count(*)) AS r2"""


@register("regression_metrics", "WITH " + PRED_SQL + f"""
SELECT o_orderpriority, {METRICS_SQL} FROM po GROUP BY o_orderpriority""")
def q_regression_metrics(spark, d):
    return ml.regression_metrics(_pred_actual(T(spark, d)), "predicted", "actual", ["o_orderpriority"])


@register("drift_score", """
WITH x AS (SELECT ts, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
s AS (SELECT avg(value) FILTER (WHERE ts < TIMESTAMP '2024-01-16') AS tm0,
             stddev_samp(value) FILTER (WHERE ts < TIMESTAMP '2024-01-16') AS ts0,
             avg(value) FILTER (WHERE ts >= TIMESTAMP '2024-01-24') AS pm0,
             avg(k) FILTER (WHERE ts < TIMESTAMP '2024-01-16') AS tm1,
             stddev_samp(k) FILTER (WHERE ts < TIMESTAMP '2024-01-16') AS ts1,
             avg(k) FILTER (WHERE ts >= TIMESTAMP '2024-01-24') AS pm1 FROM x)
SELECT 'value' AS feature, round(tm0, 6) AS train_mean, round(pm0, 6) AS prod_mean, round(ts0, 6) AS train_std,
       round(abs(tm0 - pm0) / ts0, 6) AS drift_score, abs(tm0 - pm0) / ts0 > 2 AS alert FROM s
UNION ALL
SELECT 'k', round(tm1, 6), round(pm1, 6), round(ts1, 6), round(abs(tm1 - pm1) / ts1, 6), abs(tm1 - pm1) / ts1 > 2 FROM s""")
def q_drift_score(spark, d):
    ev = T(spark, d).events.withColumn("k", F.get_json_object("props", "$.k").cast("double"))
    r = ml.drift(ev, F.col("ts") < ts_lit(dt.datetime(2024, 1, 16)), F.col("ts") >= ts_lit(dt.datetime(2024, 1, 24)),
                 ["value", "k"])
    return r.select("feature", *[F.round(c, 6).alias(c) for c in
                                 ("train_mean", "prod_mean", "train_std", "drift_score")], "alert")


@register("model_error_trend", "WITH " + PRED_SQL + """,
daily AS (SELECT day, CAST(sum(abs(predicted - actual)) AS DOUBLE) / count(*) AS mae FROM po GROUP BY day)
SELECT day, mae, lag(mae) OVER (ORDER BY day) AS prev_mae,
       (mae - lag(mae) OVER (ORDER BY day)) / lag(mae) OVER (ORDER BY day) * 100 AS mae_change_pct
FROM daily""")
def q_model_error_trend(spark, d):
    from pyspark.sql import Window
    pa = _pred_actual(T(spark, d))
    daily = pa.groupBy("day").agg((F.sum(F.abs(F.col("predicted") - F.col("actual"))).cast("double")
                                   / F.count(F.lit(1))).alias("mae"))
    w = Window.orderBy("day")  # day grain: bounded by the calendar, not the data
    prev = F.lag("mae").over(w)
    return daily.select("day", "mae", prev.alias("prev_mae"),
                        (F.try_divide(F.col("mae") - prev, prev) * 100).alias("mae_change_pct"))


@register("ab_split", """
SELECT CASE WHEN CAST('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 15) AS BIGINT) % 2 = 0 THEN 'A' ELSE 'B' END
         AS test_group,
       count(*) AS n,
       CAST(count(*) FILTER (WHERE event_type = 'purchase') AS DOUBLE) / count(*) AS purchase_rate,
       CAST(count(*) FILTER (WHERE event_type = 'error') AS DOUBLE) / count(*) AS error_rate,
       CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / count(value) AS avg_value
FROM events GROUP BY 1""")
def q_ab_split(spark, d):
    ev = ml.ab_assign(T(spark, d).events, "user_id")
    return ml.group_rates(ev, "test_group", {"purchase": F.col("event_type") == "purchase",
                                             "error": F.col("event_type") == "error"}, "value")


DECISION_RULES = [("fraud_score > 0.8", "BLOCKED"), ("risk_score > 0.7", "REVIEW")]
TIER_RULES = [("customer_value > 2500", "PREMIUM"), ("customer_value > 1500", "GOLD")]


@register("decision_rules", """
WITH cv AS (SELECT user_id, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS customer_value FROM events GROUP BY user_id)
SELECT e.event_id,
       CASE WHEN CAST(json_extract_string(e.props, '$.k') AS DOUBLE) / 100 > 0.8 THEN 'BLOCKED'
            WHEN e.value / 500 > 0.7 THEN 'REVIEW' ELSE 'APPROVED' END AS transaction_status,
       CASE WHEN cv.customer_value > 2500 THEN 'PREMIUM' WHEN cv.customer_value > 1500 THEN 'GOLD' ELSE 'STANDARD' END
         AS customer_tier
FROM events e JOIN cv ON e.user_id = cv.user_id""")
def q_decision_rules(spark, d):
    ev = T(spark, d).events
    cv = ev.groupBy("user_id").agg(F.sum(dec("value")).cast("double").alias("customer_value"))
    scored = (ev.join(cv, "user_id")
              .withColumns({"fraud_score": F.get_json_object("props", "$.k").cast("double") / 100,
                            "risk_score": F.col("value") / 500}))
    out = ml.decision_rules(scored, DECISION_RULES, "APPROVED", "transaction_status")
    out = ml.decision_rules(out, TIER_RULES, "STANDARD", "customer_tier")
    return out.select("event_id", "transaction_status", "customer_tier")


@register("tenure_features", """
WITH o AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first_order,
                  sum(CAST(o_totalprice AS DECIMAL(12,2))) AS spend FROM orders GROUP BY o_custkey)
SELECT o_custkey, CAST(date_diff('day', first_order, DATE '2002-01-01') AS INTEGER) AS tenure_days,
       CASE WHEN date_diff('day', first_order, DATE '2002-01-01') = 0 THEN NULL
            ELSE CAST(spend AS DOUBLE) / date_diff('day', first_order, DATE '2002-01-01') * 30 END AS avg_monthly_spend
FROM o""")
def q_tenure_features(spark, d):
    o = T(spark, d).orders.groupBy("o_custkey").agg(F.min(F.to_date("o_orderdate")).alias("first_order"),
                                                    F.sum(dec("o_totalprice")).alias("spend"))
    return ml.tenure_features(o, "first_order", "spend", dt.date(2002, 1, 1)) \
        .select("o_custkey", "tenure_days", "avg_monthly_spend")


@register("retrain_gate", "WITH " + PRED_SQL + f""",
m AS (SELECT o_orderpriority, max(day) AS trained_at, {METRICS_SQL} FROM po GROUP BY o_orderpriority)
SELECT o_orderpriority, r2, CAST(date_diff('day', trained_at, DATE '2001-08-10') AS INTEGER) AS age_days,
       date_diff('day', trained_at, DATE '2001-08-10') > 7 OR r2 < 0.8 AS needs_retrain, r2 > 0.85 AS promote
FROM m""")
def q_retrain_gate(spark, d):
    pa = _pred_actual(T(spark, d))
    m = ml.regression_metrics(pa, "predicted", "actual", ["o_orderpriority"])
    trained = pa.groupBy("o_orderpriority").agg(F.max("day").alias("trained_at"))
    g = ml.retrain_gate(m.join(trained, "o_orderpriority"), "trained_at", "r2", dt.date(2001, 8, 10))
    return g.select("o_orderpriority", "r2", "age_days", "needs_retrain", "promote")


# ====================================================================== U

EMAIL_SQL = pv.EMAIL_PATTERN


@register("udf_python", f"""
SELECT doc_id, coalesce(regexp_matches(text, '{EMAIL_SQL}'), false) AS has_email FROM documents""")
def q_udf_python(spark, d):
    return T(spark, d).documents.select("doc_id", udfs.contains_email("text").alias("has_email"))


@register("udf_pandas", """
SELECT doc_id, CAST(len(string_split(text, ' ')) AS BIGINT) AS n_tokens FROM documents""")
def q_udf_pandas(spark, d):
    return T(spark, d).documents.select("doc_id", udfs.token_count("text").alias("n_tokens"))


@register("udf_sql", f"""
SELECT doc_id, left(split_part(email, '@', 1), 2) || '***@' || split_part(email, '@', 2) AS masked_email
FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{EMAIL_SQL}')) AS email FROM documents)""")
def q_udf_sql(spark, d):
    udfs.register_sql_functions(spark)
    e = pv.extract_emails(T(spark, d).documents.select("doc_id", "text"), "text")
    return e.select("doc_id", F.call_function(udfs.MASK_FUNCTION, F.col("email")).alias("masked_email"))


@register("udf_struct", """
SELECT c_custkey, ['segment:' || lower(coalesce(c_mktsegment, 'NONE')), 'tier:' || CASE WHEN coalesce(c_acctbal, 0) < 5000 THEN 'basic' ELSE 'premium' END] AS recommendations
FROM customer""")
def q_udf_struct(spark, d):
    c = T(spark, d).customer
    arg = F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    return c.select("c_custkey", udfs.recommend(arg).alias("recommendations"))
