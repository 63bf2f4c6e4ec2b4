"""Unit tests on the small fixtures of FIXTURES.md part A (the reference's own
test inputs) plus the edge rows of ours."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DoubleType, LongType, StringType, StructField,
                               StructType)
from pyspark.testing import assertDataFrameEqual

from tidemark.functions import calendar as cal
from tidemark.operators import snapshots as snap

D = dt.date


def test_quarter_end_twelve_months(spark):
    spine = cal.month_spine(spark, 2024, 2024, 12)
    got = [r.QUARTER_END for r in cal.quarter_end(spine).orderBy("MONTH_END").collect()]
    exp = [D(2024, m, d) for m, d in [(3, 31)] * 3 + [(6, 30)] * 3 + [(9, 30)] * 3 + [(12, 31)] * 3]
    assert got == exp


def test_quarter_end_mid_month_and_null(spark):
    df = spark.createDataFrame([(D(2024, 3, 15),), (D(2024, 2, 15),), (None,)], "MONTH_END date")
    got = {r.MONTH_END: r.QUARTER_END for r in cal.quarter_end(df).collect()}
    assert got == {D(2024, 3, 15): D(2024, 3, 15), D(2024, 2, 15): D(2024, 3, 31), None: None}


def test_month_spine(spark):
    s = cal.month_spine(spark, 2017, 2024, 12)
    r = s.agg(F.min("MONTH_END").alias("lo"), F.max("MONTH_END").alias("hi"), F.count("*").alias("n")).first()
    assert (r.lo, r.hi, r.n) == (D(2017, 1, 31), D(2024, 12, 31), 96)
    assert s.where(F.col("MONTH_END") != F.last_day("MONTH_END")).count() == 0


def test_prev_month_is_quarter_end(spark):
    cases = [(D(2025, 4, 1), 1), (D(2025, 7, 1), 1), (D(2025, 10, 1), 1), (D(2026, 1, 1), 1),
             (D(2025, 5, 1), 0), (D(2025, 8, 1), 0)]
    df = spark.createDataFrame([(d,) for d, _ in cases], "d date")
    native = df.select("d", cal.prev_month_is_quarter_end("d").alias("x"),
                       cal.prev_month_is_quarter_end_udf("d").alias("y")).collect()
    exp = dict(cases)
    for r in native:
        assert r.x == exp[r.d] and r.y == exp[r.d]


def test_prev_month_january(spark):
    df = spark.createDataFrame([(D(2025, 1, 20),)], "d date")
    assert df.select(cal.prev_month("d").alias("p")).first().p == D(2024, 12, 1)


AGG_SCHEMA = StructType([
    StructField("MONTH_END", DateType()), StructField("QUARTER_END", DateType()),
    StructField("MATTER_CATEGORY_SK", LongType()), StructField("MATTER_STATUS_CODE", StringType()),
    StructField("FIRM_PAID", DoubleType()), StructField("ALAS_PAID", DoubleType()),
    StructField("COINS_PAID", DoubleType()), StructField("TOTAL_INCURRED", DoubleType()),
    StructField("COINS_RESERVE", DoubleType()), StructField("GROUND_UP_PAID", DoubleType()),
    StructField("LOB", LongType())])
AGG_ROWS = [
    (D(2024, 1, 31), D(2024, 3, 31), 2, "Open", 1000.0, 500.0, 300.0, 1200.0, 200.0, 800.0, 1),
    (D(2024, 1, 31), D(2024, 3, 31), 2, "Closed", 2000.0, 700.0, 400.0, 1500.0, 300.0, 900.0, 1),
    (D(2024, 2, 28), D(2024, 3, 31), 2, "Open", 1500.0, 600.0, 300.0, 1300.0, 300.0, 1000.0, 4),
]


def test_aggregate_snapshots_as_coded(spark):
    df = spark.createDataFrame(AGG_ROWS, AGG_SCHEMA)
    got = snap.totals(df, ["MONTH_END", "QUARTER_END", "LOB"], {**snap.money(), "CL01_COUNT": snap.open_flag()})
    exp = spark.createDataFrame(
        [(D(2024, 1, 31), D(2024, 3, 31), 1, 3000.0, 1200.0, 2700.0, 1700.0, 1),
         (D(2024, 2, 28), D(2024, 3, 31), 4, 1500.0, 600.0, 1300.0, 1000.0, 1)],
        "MONTH_END date, QUARTER_END date, LOB bigint, FIRM_PAID double, PAID_LOSS double, "
        "INCURRED_LOSS double, GROUND_UP_PAID double, CL01_COUNT bigint")
    assertDataFrameEqual(got, exp)


def test_aggregate_snapshots_gross(spark):
    df = spark.createDataFrame(AGG_ROWS, AGG_SCHEMA)
    got = snap.totals(df, ["MONTH_END", "QUARTER_END", "LOB"], snap.money(gross=True)) \
        .select("LOB", "PAID_LOSS", "INCURRED_LOSS", "GROUND_UP_PAID")
    exp = spark.createDataFrame([(1, 1900.0, 3900.0, 2400.0), (4, 900.0, 1900.0, 1300.0)],
                                "LOB bigint, PAID_LOSS double, INCURRED_LOSS double, GROUND_UP_PAID double")
    assertDataFrameEqual(got, exp)


def test_indicators(spark):
    df = spark.createDataFrame([(2, 1), (4, 2), (9, 1), (10, 3), (3, 1), (None, None)],
                               "MATTER_CATEGORY_SK bigint, LOB_SK bigint")
    got = {(r.MATTER_CATEGORY_SK, r.LOB_SK): (r.IS_CLAIM, r.IS_REAL_CLAIM, r.IS_SUPPLEMENTAL)
           for r in snap.add_indicators(df).collect()}
    assert got == {(2, 1): (1, 1, 0), (4, 2): (1, 1, 1), (9, 1): (0, 0, 0), (10, 3): (0, 0, 1),
                   (3, 1): (1, 0, 0), (None, None): (0, 0, 1)}
    named = spark.createDataFrame([(2, "LPL"), (2, "OTHER")], "MATTER_CATEGORY_SK bigint, LOB string")
    assert {r.LOB: r.IS_SUPPLEMENTAL for r in snap.add_indicators(named).collect()} == {"LPL": 0, "OTHER": 1}


def test_period_change(spark):
    df = spark.createDataFrame(
        [(D(2024, 1, 31), 1, 5, 10), (D(2024, 2, 28), 1, 8, 18), (D(2024, 3, 31), 1, 12, 25),
         (D(2024, 1, 31), 2, 1, 1), (D(2024, 3, 31), 2, 4, 9), (D(2024, 1, 31), None, 7, 7),
         (D(2024, 2, 28), None, 9, 10)],
        "MONTH_END date, LOB bigint, MATTER_COUNT bigint, CLAIM_COUNT bigint")
    got = {(r.MONTH_END, r.LOB): (r.MATTER_COUNT, r.CLAIM_COUNT)
           for r in snap.period_change(df, ["MONTH_END"], ["LOB"], ["MATTER_COUNT", "CLAIM_COUNT"]).collect()}
    assert got[(D(2024, 1, 31), 1)] == (None, None)
    assert got[(D(2024, 2, 28), 1)] == (3, 8)
    assert got[(D(2024, 3, 31), 1)] == (4, 7)
    assert got[(D(2024, 3, 31), 2)] == (3, 8)           # gap: difference to previous present row
    assert got[(D(2024, 2, 28), None)] == (2, 3)        # NULL key is its own group
    nogrp = snap.period_change(df.where("LOB = 1"), ["MONTH_END"], [], ["MATTER_COUNT"])
    assert sorted(r.MATTER_COUNT or 0 for r in nogrp.collect()) == [0, 3, 4]


def test_select_periods_counts_quarter_month_once(spark):
    df = spark.createDataFrame([(D(2024, 3, 31), D(2024, 3, 31)), (D(2024, 2, 29), D(2024, 3, 31)),
                                (D(2024, 4, 30), D(2024, 6, 30))], "MONTH_END date, QUARTER_END date")
    assert snap.select_periods(df, "2024-03-31").count() == 1
    assert snap.select_periods(df, "latest").count() == 2
    assert snap.select_periods(df).count() == 1


def test_emergence_sums_to_last_minus_first(spark):
    from tidemark.plans.snapshot import _bronze
    from conftest import SF_SMALL
    b = _bronze(spark, SF_SMALL)
    agg = snap.silver_aggregate(b, True, None)
    mom = snap.silver_emergence(agg, True)
    keys = ["PRIMARY_CAUSE_OF_LOSS_SK", "AOP_SK"]
    s = mom.groupBy(*keys).agg(F.sum("FIRM_PAID").alias("s"))
    w = agg.groupBy(*keys).agg(F.max_by("FIRM_PAID", "QUARTER_END").alias("last"),
                               F.min_by("FIRM_PAID", "QUARTER_END").alias("first"),
                               F.count("*").alias("n"))
    j = s.join(w, keys).where("n > 1")
    assert j.where(F.col("s") != F.col("last") - F.col("first")).count() == 0


def test_expect_or_fail_raises(spark):
    import pytest
    from tidemark.operators.quality import expect_or_fail
    df = spark.createDataFrame([(1,), (None,)], "x int")
    with pytest.raises(Exception, match="expectation failed"):
        expect_or_fail(df, {"x present": "x IS NOT NULL"}).collect()
    assert expect_or_fail(df.where("x IS NOT NULL"), {"x present": "x IS NOT NULL"}).count() == 1


def test_gold_reads_the_facts_once(spark):
    """One scan of the facts for the rows and one, of the code column alone, for
    each lookup; only month totals are written."""
    from tidemark import session
    from tidemark.plans.snapshot import _bronze
    from conftest import SF_SMALL
    plan = snap.month_totals(_bronze(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1 and plan.count("orders.parquet") <= 2
    months = snap.month_totals(_bronze(spark, SF_SMALL))
    assert months.columns == ["MONTH_END", "QUARTER_END", *snap.GOLD_KEYS, *snap.NET_OF]


def test_rows_of_no_line_only_tell_their_month(spark):
    rows = [(D(2024, 3, 31), D(2024, 3, 31), 1, 5, 7, 9, 1.0), (D(2024, 4, 30), D(2024, 6, 30), 3, 5, 7, 9, 2.0), (D(2024, 5, 31), D(2024, 6, 30), None, 5, 7, 9, 4.0)]
    df = spark.createDataFrame([(*r, r[-1], r[-1], r[-1]) for r in rows], "MONTH_END date, QUARTER_END date, LOB_SK bigint, AOP_SK bigint, PRIMARY_CAUSE_OF_LOSS_SK bigint, "
                               "CLAIMANT_TYPE_SK bigint, FIRM_PAID double, ALAS_PAID double, TOTAL_INCURRED double, GROUND_UP_PAID double")
    got = {(r.QUARTER_END, r.LOB_SK, r.AOP_SK, r.CLAIMANT_TYPE_SK, r.FIRM_PAID) for r in snap.gold_aggregate(df, "latest").collect()}
    assert got == {(D(2024, 3, 31), 1, 5, -2, 1.0)}                  # the newest month is May, which has no line
    got = {(r.QUARTER_END, r.LOB_SK, r.AOP_SK, r.CLAIMANT_TYPE_SK, r.FIRM_PAID) for r in snap.gold_aggregate(df, "2024-04-30").collect()}
    assert got == {(D(2024, 3, 31), 1, 5, -2, 1.0), (D(2024, 6, 30), 4, -2, 9, 2.0)}
