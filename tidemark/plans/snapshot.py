"""Registered snapshot-trend queries over the driver tables, with their
DuckDB oracle SQL side by side.

Each query is ``(spark, sf_dir) -> DataFrame``. Money is exact DECIMAL inside
and DOUBLE at the report edge on both sides, so value hashes match exactly.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import calendar as cal
from tidemark.operators import snapshots as snap
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


# ---------------------------------------------------------------- SQL pieces

QE_SQL = ("CASE WHEN last_day({d}) = CAST(last_day(date_trunc('quarter', {d}) + INTERVAL 2 MONTH) AS DATE) "
          "THEN {d} ELSE CAST(last_day(date_trunc('quarter', {d}) + INTERVAL 2 MONTH) AS DATE) END")

SNAP_CTE = """
snap AS (
  SELECT CAST(l.l_orderkey AS BIGINT) AS MATTER_SK,
         last_day(CAST(l.l_shipdate AS DATE)) AS AS_OF_DATE,
         CAST(o.o_custkey % 4 + 1 AS BIGINT) AS LOB_SK,
         CAST(l.l_linenumber AS BIGINT) AS AOP_SK,
         CAST(p.p_size AS BIGINT) AS PRIMARY_CAUSE_OF_LOSS_SK,
         CAST(l.l_partkey % 11 + 1 AS BIGINT) AS MATTER_CATEGORY_SK,
         CASE WHEN o.o_orderstatus = 'O' THEN 'Open' ELSE 'Closed' END AS MATTER_STATUS_CODE,
         CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_discount AS DECIMAL(12,2)) AS DECIMAL(18,4)) AS FIRM_PAID,
         CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(12,2))) AS DECIMAL(18,4)) AS ALAS_PAID,
         CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 + CAST(l.l_tax AS DECIMAL(12,2))) AS DECIMAL(18,4)) AS TOTAL_INCURRED,
         CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(18,4)) AS GROUND_UP_PAID,
         CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_tax AS DECIMAL(12,2)) AS DECIMAL(18,4)) AS COINS_PAID,
         CAST(CAST(l.l_quantity AS DECIMAL(12,2)) AS DECIMAL(18,4)) AS COINS_RESERVE,
         CAST(l.l_linenumber AS BIGINT) AS SRC_LINE, l.l_partkey AS SRC_PART,
         l.l_suppkey AS SRC_SUPP, l.l_shipdate AS SRC_SHIPDATE
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                  JOIN part p ON l.l_partkey = p.p_partkey)"""

RAW_CTE = SNAP_CTE + """,
raw_matters AS (
  SELECT CAST(o_orderkey AS BIGINT) AS MATTER_SK, CAST(o_orderdate AS DATE) AS DATE_REPORTED,
         CAST(o_custkey % 5 AS BIGINT) AS CLAIMANT_TYPE_SK FROM orders),
raw AS (
  SELECT s.* EXCLUDE (AS_OF_DATE), s.AS_OF_DATE AS MONTH_END,
         CASE WHEN s.MATTER_CATEGORY_SK < 9 THEN 1 ELSE 0 END AS IS_CLAIM,
         CASE WHEN s.MATTER_CATEGORY_SK IN (2, 4, 5, 6, 7) THEN 1 ELSE 0 END AS IS_REAL_CLAIM,
         CASE WHEN s.LOB_SK = 1 THEN 0 ELSE 1 END AS IS_SUPPLEMENTAL,
         m.DATE_REPORTED, m.CLAIMANT_TYPE_SK,
         """ + QE_SQL.format(d="s.AS_OF_DATE") + """ AS QUARTER_END
  FROM snap s LEFT JOIN raw_matters m ON s.MATTER_SK = m.MATTER_SK)"""

LOOKUP_CTE = """
aop_lookup AS (
  SELECT DISTINCT CAST(l_linenumber AS BIGINT) AS AOP_SK,
         'G' || CAST(CAST(l_linenumber AS BIGINT) % 3 AS VARCHAR) AS AOP_GROUP_2 FROM lineitem),
aop_min AS (SELECT AOP_GROUP_2, min(AOP_SK) AS rep FROM aop_lookup GROUP BY AOP_GROUP_2),
cause_lookup AS (
  SELECT DISTINCT CAST(p_size AS BIGINT) AS PRIMARY_CAUSE_OF_LOSS_SK,
         'C' || CAST(CAST(p_size AS BIGINT) % 10 AS VARCHAR) AS CAUSE_TYPE FROM part),
cause_min AS (SELECT CAUSE_TYPE, min(PRIMARY_CAUSE_OF_LOSS_SK) AS rep FROM cause_lookup GROUP BY CAUSE_TYPE)"""

BRONZE_CTE = "WITH " + RAW_CTE + "," + LOOKUP_CTE + """,
dedup AS (
  SELECT * FROM raw
  QUALIFY row_number() OVER (PARTITION BY MATTER_SK, MONTH_END
                             ORDER BY SRC_LINE, SRC_PART, SRC_SUPP, SRC_SHIPDATE) = 1),
bronze AS (
  SELECT d.* REPLACE (
           CASE WHEN d.IS_SUPPLEMENTAL = 1 THEN CAST(-2 AS BIGINT) ELSE am.rep END AS AOP_SK,
           CASE WHEN d.LOB_SK = 1 THEN cm.rep WHEN d.LOB_SK > 1 THEN d.PRIMARY_CAUSE_OF_LOSS_SK END
             AS PRIMARY_CAUSE_OF_LOSS_SK)
  FROM dedup d
  LEFT JOIN aop_lookup al ON d.AOP_SK = al.AOP_SK
  LEFT JOIN aop_min am ON al.AOP_GROUP_2 = am.AOP_GROUP_2
  LEFT JOIN cause_lookup cl ON d.PRIMARY_CAUSE_OF_LOSS_SK = cl.PRIMARY_CAUSE_OF_LOSS_SK
  LEFT JOIN cause_min cm ON cl.CAUSE_TYPE = cm.CAUSE_TYPE)"""

PERIODS_CTE = """,
periods AS (
  SELECT * FROM bronze
  WHERE MONTH_END = QUARTER_END OR MONTH_END = (SELECT max(MONTH_END) FROM bronze))"""

MONEY_SUMS_SQL = """sum(FIRM_PAID) AS FIRM_PAID, sum(ALAS_PAID) AS PAID_LOSS,
         sum(TOTAL_INCURRED) AS INCURRED_LOSS, sum(GROUND_UP_PAID) AS GROUND_UP_PAID"""

SILVER_CTE = BRONZE_CTE + PERIODS_CTE + """,
agg_p AS (
  SELECT QUARTER_END, PRIMARY_CAUSE_OF_LOSS_SK, AOP_SK, """ + MONEY_SUMS_SQL + """,
         CAST(1 AS BIGINT) AS LOB_SK, CAST(-2 AS BIGINT) AS CLAIMANT_TYPE_SK
  FROM periods WHERE LOB_SK = 1 GROUP BY QUARTER_END, PRIMARY_CAUSE_OF_LOSS_SK, AOP_SK),
agg_s AS (
  SELECT QUARTER_END, PRIMARY_CAUSE_OF_LOSS_SK, CLAIMANT_TYPE_SK, """ + MONEY_SUMS_SQL + """,
         CAST(4 AS BIGINT) AS LOB_SK, CAST(-2 AS BIGINT) AS AOP_SK
  FROM periods WHERE LOB_SK > 1 GROUP BY QUARTER_END, PRIMARY_CAUSE_OF_LOSS_SK, CLAIMANT_TYPE_SK)"""


def _diff(grp):
    cols = []
    for c in ("FIRM_PAID", "PAID_LOSS", "INCURRED_LOSS", "GROUND_UP_PAID"):
        cols.append(f"{c} - lag({c}) OVER (PARTITION BY {grp} ORDER BY QUARTER_END) AS {c}")
    return ",\n         ".join(cols)


EMERGE_CTE = SILVER_CTE + """,
mom_p AS (
  SELECT QUARTER_END, PRIMARY_CAUSE_OF_LOSS_SK, AOP_SK, LOB_SK, CLAIMANT_TYPE_SK,
         """ + _diff("PRIMARY_CAUSE_OF_LOSS_SK, AOP_SK") + """
  FROM agg_p),
mom_s AS (
  SELECT QUARTER_END, PRIMARY_CAUSE_OF_LOSS_SK, CLAIMANT_TYPE_SK, LOB_SK, AOP_SK,
         """ + _diff("PRIMARY_CAUSE_OF_LOSS_SK, CLAIMANT_TYPE_SK") + """
  FROM agg_s)"""

GOLD_SELECT = """SELECT QUARTER_END, LOB_SK, AOP_SK, PRIMARY_CAUSE_OF_LOSS_SK, CLAIMANT_TYPE_SK,
       CAST(FIRM_PAID AS DOUBLE) AS FIRM_PAID, CAST(PAID_LOSS AS DOUBLE) AS PAID_LOSS,
       CAST(INCURRED_LOSS AS DOUBLE) AS INCURRED_LOSS, CAST(GROUND_UP_PAID AS DOUBLE) AS GROUND_UP_PAID
FROM {t}"""

ROW_MONEY = ["FIRM_PAID", "ALAS_PAID", "TOTAL_INCURRED", "GROUND_UP_PAID", "COINS_PAID", "COINS_RESERVE"]
# ---------------------------------------------------------------- builders

def _bronze(spark, sf_dir):
    """The bronze layer; its readers take it once, so it is not written."""
    t = tables(spark, sf_dir)
    return snap.bronze_snapshots(_raw(spark, sf_dir), t.aop_lookup(), t.cause_lookup())


def _rows_out(df):
    return df.withColumns({c: F.col(c).cast("double") for c in ROW_MONEY if c in df.columns})


# ---------------------------------------------------------------- calendar (T-01..T-05)

@register("quarter_end", f"""
SELECT CAST(l_shipdate AS DATE) AS SHIP_DATE,
       {QE_SQL.format(d="CAST(l_shipdate AS DATE)")} AS QUARTER_END,
       count(*) AS n_lines
FROM lineitem GROUP BY 1, 2""")
def q_quarter_end(spark, sf_dir):
    li = tables(spark, sf_dir).lineitem
    d = F.to_date("l_shipdate")
    return (li.groupBy(d.alias("SHIP_DATE"), cal.quarter_end_of(d).alias("QUARTER_END"))
            .agg(F.count(F.lit(1)).alias("n_lines")))


@register("month_spine", """
SELECT CAST(last_day(CAST(d AS DATE)) AS DATE) AS MONTH_END
FROM (SELECT unnest(generate_series(CAST(make_date(year(min(l_shipdate)), 1, 1) AS TIMESTAMP),
                                    CAST(date_trunc('month', max(l_shipdate)) AS TIMESTAMP),
                                    INTERVAL 1 MONTH)) AS d
      FROM lineitem)""")
def q_month_spine(spark, sf_dir):
    li = tables(spark, sf_dir).lineitem
    bounds = li.agg(F.make_date(F.year(F.min("l_shipdate")), F.lit(1), F.lit(1)).alias("lo"),
                    F.to_date(F.max("l_shipdate")).alias("hi"))
    return cal.month_spine_between(bounds, "lo", "hi")


@register("prev_month", """
SELECT REF_DATE, CAST(date_trunc('month', REF_DATE) - INTERVAL 1 MONTH AS DATE) AS PREV_MONTH,
       CAST(year(date_trunc('month', REF_DATE) - INTERVAL 1 MONTH) AS INTEGER) AS SNAP_YEAR,
       CAST(month(date_trunc('month', REF_DATE) - INTERVAL 1 MONTH) AS INTEGER) AS SNAP_MONTH
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS REF_DATE FROM orders)""")
def q_prev_month(spark, sf_dir):
    o = tables(spark, sf_dir).orders
    d = o.select(F.to_date("o_orderdate").alias("REF_DATE")).distinct()
    pm = cal.prev_month("REF_DATE")
    return d.select("REF_DATE", pm.alias("PREV_MONTH"), F.year(pm).alias("SNAP_YEAR"),
                    F.month(pm).alias("SNAP_MONTH"))


PREV_QE_SQL = """
SELECT REF_DATE,
       CAST(CASE WHEN month(date_trunc('month', REF_DATE) - INTERVAL 1 MONTH) % 3 = 0 THEN 1 ELSE 0 END AS INTEGER)
         AS PREV_MONTH_IS_QE
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS REF_DATE FROM orders)"""


@register("prev_month_is_qe", PREV_QE_SQL)
def q_prev_month_is_qe(spark, sf_dir):
    o = tables(spark, sf_dir).orders
    d = o.select(F.to_date("o_orderdate").alias("REF_DATE")).distinct()
    return d.select("REF_DATE", cal.prev_month_is_quarter_end("REF_DATE").alias("PREV_MONTH_IS_QE"))


@register("prev_month_is_qe_udf", PREV_QE_SQL)
def q_prev_month_is_qe_udf(spark, sf_dir):
    o = tables(spark, sf_dir).orders
    d = o.select(F.to_date("o_orderdate").alias("REF_DATE")).distinct()
    return d.select("REF_DATE", cal.prev_month_is_quarter_end_udf("REF_DATE").alias("PREV_MONTH_IS_QE"))


# ---------------------------------------------------------------- T-06..T-09

@register("claim_indicators", "WITH " + SNAP_CTE + """
SELECT MATTER_CATEGORY_SK, LOB_SK,
       CASE WHEN MATTER_CATEGORY_SK < 9 THEN 1 ELSE 0 END AS IS_CLAIM,
       CASE WHEN MATTER_CATEGORY_SK IN (2, 4, 5, 6, 7) THEN 1 ELSE 0 END AS IS_REAL_CLAIM,
       CASE WHEN LOB_SK = 1 THEN 0 ELSE 1 END AS IS_SUPPLEMENTAL,
       count(*) AS n_rows
FROM snap GROUP BY ALL""")
def q_claim_indicators(spark, sf_dir):
    s = tables(spark, sf_dir).snapshots().transform(snap.add_indicators)
    return (s.groupBy("MATTER_CATEGORY_SK", "LOB_SK", "IS_CLAIM", "IS_REAL_CLAIM", "IS_SUPPLEMENTAL")
            .agg(F.count(F.lit(1)).alias("n_rows")))


def _agg_sql(gross: bool):
    if gross:
        paid, inc, gu = ("ALAS_PAID + COINS_PAID", "TOTAL_INCURRED + COINS_PAID + COINS_RESERVE",
                         "GROUND_UP_PAID + COINS_PAID")
    else:
        paid, inc, gu = "ALAS_PAID", "TOTAL_INCURRED", "GROUND_UP_PAID"
    return "WITH " + RAW_CTE + f"""
SELECT MONTH_END, QUARTER_END, LOB_SK,
       CAST(sum(FIRM_PAID) AS DOUBLE) AS FIRM_PAID, CAST(sum({paid}) AS DOUBLE) AS PAID_LOSS,
       CAST(sum({inc}) AS DOUBLE) AS INCURRED_LOSS, CAST(sum({gu}) AS DOUBLE) AS GROUND_UP_PAID,
       CAST(sum(CASE WHEN MATTER_CATEGORY_SK = 2 AND MATTER_STATUS_CODE = 'Open' THEN 1 ELSE 0 END) AS BIGINT)
         AS CL01_COUNT
FROM raw GROUP BY MONTH_END, QUARTER_END, LOB_SK"""


def _raw(spark, sf_dir):
    t = tables(spark, sf_dir)
    return snap.raw_snapshots(t.snapshots(), t.raw_matters())


@register("snapshot_aggregate", _agg_sql(False))
def q_snapshot_aggregate(spark, sf_dir):
    out = snap.totals(_raw(spark, sf_dir), ["MONTH_END", "QUARTER_END", "LOB_SK"], {**snap.money(), "CL01_COUNT": snap.open_flag()})
    return snap.money_to_double(out).withColumn("CL01_COUNT", F.col("CL01_COUNT").cast("bigint"))


@register("snapshot_aggregate_gross", _agg_sql(True))
def q_snapshot_aggregate_gross(spark, sf_dir):
    out = snap.totals(_raw(spark, sf_dir), ["MONTH_END", "QUARTER_END", "LOB_SK"], {**snap.money(gross=True), "CL01_COUNT": snap.open_flag()})
    return snap.money_to_double(out).withColumn("CL01_COUNT", F.col("CL01_COUNT").cast("bigint"))


@register("period_change", "WITH " + RAW_CTE + """,
monthly AS (
  SELECT MONTH_END, LOB_SK, count(*) AS MATTER_COUNT,
         CAST(sum(IS_CLAIM) AS BIGINT) AS CLAIM_COUNT, sum(FIRM_PAID) AS FIRM_PAID
  FROM raw GROUP BY MONTH_END, LOB_SK)
SELECT MONTH_END, LOB_SK,
       MATTER_COUNT - lag(MATTER_COUNT) OVER (PARTITION BY LOB_SK ORDER BY MONTH_END) AS MATTER_COUNT,
       CLAIM_COUNT - lag(CLAIM_COUNT) OVER (PARTITION BY LOB_SK ORDER BY MONTH_END) AS CLAIM_COUNT,
       CAST(FIRM_PAID - lag(FIRM_PAID) OVER (PARTITION BY LOB_SK ORDER BY MONTH_END) AS DOUBLE) AS FIRM_PAID
FROM monthly""")
def q_period_change(spark, sf_dir):
    monthly = (_raw(spark, sf_dir).groupBy("MONTH_END", "LOB_SK")
               .agg(F.count(F.lit(1)).alias("MATTER_COUNT"),
                    F.sum("IS_CLAIM").cast("bigint").alias("CLAIM_COUNT"),
                    F.sum("FIRM_PAID").alias("FIRM_PAID")))
    out = snap.period_change(monthly, ["MONTH_END"], ["LOB_SK"],
                             ["MATTER_COUNT", "CLAIM_COUNT", "FIRM_PAID"])
    return out.withColumn("FIRM_PAID", F.col("FIRM_PAID").cast("double"))


# ---------------------------------------------------------------- T-10..T-14

RAW_OUT = ["MATTER_SK", "MONTH_END", "QUARTER_END", "LOB_SK", "AOP_SK", "PRIMARY_CAUSE_OF_LOSS_SK",
           "MATTER_CATEGORY_SK", "MATTER_STATUS_CODE", "IS_CLAIM", "IS_REAL_CLAIM", "IS_SUPPLEMENTAL",
           "DATE_REPORTED", "CLAIMANT_TYPE_SK", "FIRM_PAID", "ALAS_PAID", "TOTAL_INCURRED",
           "GROUND_UP_PAID", "SRC_LINE", "SRC_PART", "SRC_SUPP"]
RAW_OUT_SQL = ", ".join(c if c not in ROW_MONEY else f"CAST({c} AS DOUBLE) AS {c}" for c in RAW_OUT)


@register("snapshots_raw", "WITH " + RAW_CTE + f"\nSELECT {RAW_OUT_SQL} FROM raw")
def q_snapshots_raw(spark, sf_dir):
    return _rows_out(_raw(spark, sf_dir).select(*RAW_OUT))


CONFORM_OUT = ["MATTER_SK", "MONTH_END", "SRC_LINE", "SRC_PART", "SRC_SUPP", "LOB_SK",
               "AOP_SK", "PRIMARY_CAUSE_OF_LOSS_SK"]


@register("conform_aop", "WITH " + RAW_CTE + "," + LOOKUP_CTE + """
SELECT r.MATTER_SK, r.MONTH_END, r.SRC_LINE, r.SRC_PART, r.SRC_SUPP, r.LOB_SK,
       CASE WHEN r.IS_SUPPLEMENTAL = 1 THEN CAST(-2 AS BIGINT) ELSE am.rep END AS AOP_SK,
       r.PRIMARY_CAUSE_OF_LOSS_SK
FROM raw r LEFT JOIN aop_lookup al ON r.AOP_SK = al.AOP_SK
           LEFT JOIN aop_min am ON al.AOP_GROUP_2 = am.AOP_GROUP_2""")
def q_conform_aop(spark, sf_dir):
    t = tables(spark, sf_dir)
    return snap.conform_aop(_raw(spark, sf_dir), t.aop_lookup()).select(*CONFORM_OUT)


@register("conform_cause", "WITH " + RAW_CTE + "," + LOOKUP_CTE + """
SELECT r.MATTER_SK, r.MONTH_END, r.SRC_LINE, r.SRC_PART, r.SRC_SUPP, r.LOB_SK, r.AOP_SK,
       CASE WHEN r.LOB_SK = 1 THEN cm.rep WHEN r.LOB_SK > 1 THEN r.PRIMARY_CAUSE_OF_LOSS_SK END
         AS PRIMARY_CAUSE_OF_LOSS_SK
FROM raw r LEFT JOIN cause_lookup cl ON r.PRIMARY_CAUSE_OF_LOSS_SK = cl.PRIMARY_CAUSE_OF_LOSS_SK
           LEFT JOIN cause_min cm ON cl.CAUSE_TYPE = cm.CAUSE_TYPE""")
def q_conform_cause(spark, sf_dir):
    t = tables(spark, sf_dir)
    return snap.conform_cause(_raw(spark, sf_dir), t.cause_lookup()).select(*CONFORM_OUT)


@register("snapshots_bronze", BRONZE_CTE + f"\nSELECT {RAW_OUT_SQL} FROM bronze")
def q_snapshots_bronze(spark, sf_dir):
    return _rows_out(_bronze(spark, sf_dir).select(*RAW_OUT))


@register("select_periods", BRONZE_CTE + PERIODS_CTE + """
SELECT MATTER_SK, MONTH_END, QUARTER_END, LOB_SK FROM periods""")
def q_select_periods(spark, sf_dir):
    # rows are only dropped for others of their month, so the raw layer's newest month is bronze's
    return snap.select_periods(_bronze(spark, sf_dir), "latest", _raw(spark, sf_dir)) \
        .select("MATTER_SK", "MONTH_END", "QUARTER_END", "LOB_SK")


# ---------------------------------------------------------------- T-15..T-20

@register("silver_agg_primary", SILVER_CTE + "\n" + GOLD_SELECT.format(t="agg_p"))
def q_silver_agg_primary(spark, sf_dir):
    return snap.money_to_double(snap.silver_aggregate(_bronze(spark, sf_dir), True, "latest")
                                .select(*snap.GOLD_COLUMNS))


@register("silver_agg_supp", SILVER_CTE + "\n" + GOLD_SELECT.format(t="agg_s"))
def q_silver_agg_supp(spark, sf_dir):
    return snap.money_to_double(snap.silver_aggregate(_bronze(spark, sf_dir), False, "latest")
                                .select(*snap.GOLD_COLUMNS))


@register("silver_mom_primary", EMERGE_CTE + "\n" + GOLD_SELECT.format(t="mom_p"))
def q_silver_mom_primary(spark, sf_dir):
    agg = snap.silver_aggregate(_bronze(spark, sf_dir), True, "latest")
    return snap.money_to_double(snap.silver_emergence(agg, True).select(*snap.GOLD_COLUMNS))


@register("silver_mom_supp", EMERGE_CTE + "\n" + GOLD_SELECT.format(t="mom_s"))
def q_silver_mom_supp(spark, sf_dir):
    agg = snap.silver_aggregate(_bronze(spark, sf_dir), False, "latest")
    return snap.money_to_double(snap.silver_emergence(agg, False).select(*snap.GOLD_COLUMNS))


def _open_sql(primary: bool):
    if primary:
        grp, consts, where = ("PRIMARY_CAUSE_OF_LOSS_SK, AOP_SK",
                              "CAST(1 AS BIGINT) AS LOB_SK, CAST(-2 AS BIGINT) AS CLAIMANT_TYPE_SK",
                              "LOB_SK = 1")
    else:
        grp, consts, where = ("PRIMARY_CAUSE_OF_LOSS_SK, CLAIMANT_TYPE_SK",
                              "CAST(4 AS BIGINT) AS LOB_SK, CAST(-2 AS BIGINT) AS AOP_SK",
                              "LOB_SK > 1")
    return BRONZE_CTE + f"""
SELECT MONTH_END, {grp},
       CAST(sum(CASE WHEN MATTER_CATEGORY_SK = 2 AND MATTER_STATUS_CODE = 'Open' THEN 1 ELSE 0 END) AS BIGINT)
         AS CL01_COUNT,
       {consts}
FROM bronze WHERE {where} GROUP BY MONTH_END, {grp}"""


@register("open_counts_primary", _open_sql(True))
def q_open_counts_primary(spark, sf_dir):
    return snap.open_counts(_bronze(spark, sf_dir), True)


@register("open_counts_supp", _open_sql(False))
def q_open_counts_supp(spark, sf_dir):
    return snap.open_counts(_bronze(spark, sf_dir), False)


@register("gold_cumulative", SILVER_CTE + "\n" + GOLD_SELECT.format(t="agg_p")
          + "\nUNION ALL\n" + GOLD_SELECT.format(t="agg_s"))
def q_gold_cumulative(spark, sf_dir):
    return snap.money_to_double(snap.gold_cumulative(_bronze(spark, sf_dir), "latest"))


@register("gold_emergence", EMERGE_CTE + "\n" + GOLD_SELECT.format(t="mom_p")
          + "\nUNION ALL\n" + GOLD_SELECT.format(t="mom_s"))
def q_gold_emergence(spark, sf_dir):
    return snap.money_to_double(snap.gold_emergence(_bronze(spark, sf_dir), "latest"))
