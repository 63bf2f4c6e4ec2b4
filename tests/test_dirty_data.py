"""NULL keys, NULL values, hot values, zero divisors and malformed rows: the
split windows against plain windows, and jobs that must not die."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import aggregates, joins, layout, ml, privacy, quality, windows


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    data = [(rng.choice([None, "a", "b", "hot", "hot", "hot"]), rng.choice([None, *range(40)]), i, rng.choice([None, None, 7, 7, 7, rng.randrange(9)]))
            for i in range(900)]
    return spark.createDataFrame(data, "k string, t int, id int, v int").repartition(6)


def same(a, b, cols):
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, a.select(*cols).collect()), key=key) == sorted(map(tuple, b.select(*cols).collect()), key=key)


def test_bucketed_running_sum_and_row_number(rows):
    bucket = F.floor(F.col("t") / 10)
    for strict in (False, True):
        order = ["t", "id"] if strict else ["t"]
        same(windows.running_sum(rows, ["k"], order, "v", "s", rows=strict, bucket=bucket),
             windows.running_sum(rows, ["k"], order, "v", "s", rows=strict), ["k", "t", "id", "v", "s"])
    same(windows.row_numbers(rows, ["k"], ["t", "id"], "n", bucket=bucket), windows.row_numbers(rows, ["k"], ["t", "id"], "n"), ["id", "n"])


def test_a_bucket_of_nulls_carries_the_total(spark):
    df = spark.createDataFrame([(1, 0, 4), (1, 10, None), (1, 20, 2), (2, 0, None)], "k int, t int, v int")
    got = windows.running_sum(df, ["k"], ["t"], "v", "s", bucket=F.col("t"))
    assert sorted((r.k, r.t, r.s) for r in got.collect() if r.k == 1) == [(1, 0, 4), (1, 10, 4), (1, 20, 6)]
    assert [r.s for r in got.collect() if r.k == 2] == [None]


def test_bucketed_prior_rows(rows):
    bucket = F.floor(F.col("t") / 10)
    same(windows.prior_rows(rows, ["k"], ["t", "id"], "v", 3, bucket=bucket), windows.prior_rows(rows, ["k"], ["t", "id"], "v", 3),
         ["id", "_prior_sum", "_prior_cnt"])


@pytest.mark.parametrize("by", [[], ["k"]])
@pytest.mark.parametrize("dense", [False, True])
@pytest.mark.parametrize("descending", [False, True])
def test_global_rank(rows, by, dense, descending):
    key = F.col("v").desc() if descending else F.col("v").asc()
    plain = (F.dense_rank() if dense else F.rank()).over(Window.partitionBy(*by).orderBy(key))
    same(windows.global_rank(rows, "v", descending=descending, dense=dense, by=by), rows.withColumn("rank", plain), ["id", "k", "v", "rank"])


def test_percentiles_keep_the_null_group(rows):
    got = aggregates.exact_percentiles(rows, "v", ["k"], {"p50": 0.5, "p90": 0.9})
    same(got, rows.where("v IS NOT NULL").groupBy("k").agg(F.expr("percentile(v, 0.5)").alias("p50"), F.expr("percentile(v, 0.9)").alias("p90")), ["k", "p50", "p90"])


def test_zero_divisors_give_null(spark):
    one = spark.createDataFrame([(1.0, 1.0)], "p double, a double")
    assert ml.regression_metrics(one, "p", "a").first().r2 is None
    assert ml.drift(one, F.lit(True), F.lit(True), ["p"]).first().drift_score is None
    empty = spark.createDataFrame([], "s string")
    assert privacy.pii_profile(empty).first().match_rate is None
    flat = spark.createDataFrame([(1, i) for i in range(20)], "a int, b int")
    assert layout.zorder(flat, ["a", "b"], 2).count() == 20


def test_reversed_and_null_ranges_match_nothing(spark):
    facts = spark.sql("SELECT DATE '2024-02-10' AS d")
    ranges = spark.sql("SELECT * FROM VALUES (1, DATE '2024-03-01', DATE '2024-01-01'), (2, DATE '2024-01-01', CAST(NULL AS DATE)), "
                       "(3, DATE '2024-01-01', DATE '2024-03-01') AS r(i, s, e)")
    assert [r.i for r in joins.range_join(facts, ranges, "d", "s", "e").collect()] == [3]


def test_malformed_values_go_to_quarantine(spark):
    from tidemark.plans.changes_quality import EVENT_RULES
    df = spark.createDataFrame([(1.0, '{"k":"abc"}'), (1.0, '{"k":"5"}'), (None, None), (1.0, "not json")], "value double, props string")
    good, bad = quality.quarantine(df, EVENT_RULES)
    assert good.count() == 1 and bad.count() == 3


def test_warn_rules_name_the_rule(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    got = {r.x: r.warnings for r in quality.check_rules(df, [("small", "x < 3", "warn"), ("known", "x IS NOT NULL", "drop")]).collect()}
    assert got == {1: [], 5: ["small"]}
    with pytest.raises(ValueError):
        quality.check_rules(df, [("r", "x < 3", "wran")])


def test_arms_are_even_for_three(spark):
    got = ml.ab_assign(spark.range(3000).withColumnRenamed("id", "k"), "k", ("A", "B", "C")).groupBy("test_group").count().collect()
    assert len(got) == 3 and all(850 < r["count"] < 1150 for r in got)
