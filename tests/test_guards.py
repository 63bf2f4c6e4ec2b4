"""Guarded writes, contracts, input checks and sizes."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.operators import joins as jn
from tidemark.operators import layout as ly
from tidemark.operators import ml
from tidemark.operators import quality as q
from tidemark.operators import snapshots as snap
from tidemark.session import scratch_path
from tidemark.sources.contracts import SchemaContract, VersionedTable, schema_problems
from tidemark.sources.tables import tables
from tidemark.streaming import runner as sr

RULES = {"v positive": "v > 0", "v positive and small": "v < 5"}


def frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v int")


def test_guard_counts_in_the_pass_it_guards(spark):
    guarded, obs = q.expect_or_fail_counted(frame(spark, [1, 2, 3]), RULES, "g1")
    guarded.write.parquet(scratch_path(spark, "guard"))
    assert obs.get == {"rows": 3, "v positive": 0, "v positive and small": 0}
    assert q.guarded_write(frame(spark, [1, 2]), RULES, scratch_path(spark, "guard"), "g2") == ("passed", 2, None)


@pytest.mark.parametrize("bad,rule", [(0, "v positive"), (9, "v positive and small"), (None, "v positive")])
def test_guard_ends_a_batch_job(spark, bad, rule):
    assert q.guarded_write(frame(spark, [1, bad, 2]), RULES, scratch_path(spark, "guard"), "g3") == ("failed", None, rule)


def test_guard_ends_a_stream_and_lets_a_good_one_through(spark):
    for values, ends in (([1, 2], False), ([1, -1], True)):
        src = scratch_path(spark, "guard-src")
        frame(spark, values).write.parquet(src)
        stream, _ = q.expect_or_fail_counted(sr.file_stream(spark, src, "id int, v int"), RULES, "g4")
        if ends:
            with pytest.raises(Exception, match="expectation failed"):
                sr.run_stream(stream, "guard")
        else:
            run = sr.run_stream(stream, "guard")
            assert run.result().count() == 2
            counted = [p["observedMetrics"]["g4"] for p in run.progress if p["observedMetrics"]]
            assert [(c["rows"], c["v positive"]) for c in counted] == [(2, 0)]


def test_other_errors_of_a_guarded_write_are_raised(spark):
    df = frame(spark, [1]).withColumn("x", F.raise_error(F.lit("something else")))
    with pytest.raises(PySparkException, match="something else"):
        q.guarded_write(df, RULES, scratch_path(spark, "guard"), "g5")


def test_input_report_names_problems_and_scans_nothing(spark):
    t = tables(spark, SF_SMALL)
    need = {"a": {"id": "int", "w": "int", "v": "bigint"}, "b": {"id": "int"}, "c": {}, "d": {"o_orderkey": "bigint"}}
    given = {"a": frame(spark, [1]), "b": frame(spark, [1]).limit(0), "d": t.orders}
    got = {tuple(r) for r in q.input_report(spark, given, need).collect()}
    assert got == {("a", "missing column", "w"), ("a", "other type", "v int"), ("b", "empty", None), ("c", "missing table", None)}
    assert q.validate_inputs({"a": frame(spark, [1])}, {"a": ["id", "z"], "b": ["id"]}) == ["a: missing columns ['z']", "b: missing"]
    plan = q.input_report(spark, given, need)._jdf.queryExecution().toString()
    assert "orders.parquet" not in plan


def test_contract_takes_and_turns_down_batches(spark):
    base = scratch_path(spark, "contract")
    good = frame(spark, [1, 2])
    contract = SchemaContract(spark, f"{base}/schema").save(good.schema)
    assert contract.schema() == good.schema
    batches = {"good": good, "wider": good.withColumn("w", F.lit(1)), "other": good.withColumn("v", F.col("v").cast("string")), "less": good.select("id"), "turned": good.select("v", "id")}
    for name, rows in batches.items():
        rows.write.parquet(f"{base}/{name}")
    got = {r.batch: (r.accepted, r.reason) for r in contract.append({n: f"{base}/{n}" for n in batches}, f"{base}/table").collect()}
    assert got == {"good": (True, ""), "wider": (False, "unexpected w"), "other": (False, "v is string, not int"), "less": (False, "missing v"),
                   "turned": (False, "columns in another order")}
    assert spark.read.parquet(f"{base}/table").count() == 2
    assert schema_problems(good.schema, good.schema) == []


def test_overwrite_keeps_the_old_table_until_the_new_one_is_verified(spark):
    table = VersionedTable(spark, scratch_path(spark, "versioned"))
    with pytest.raises(ValueError):
        table.read()
    assert table.overwrite(frame(spark, [1, 2, 3])) == 1
    broken = frame(spark, [1, 2]).select("id", F.when(F.col("id") == 1, F.raise_error(F.lit("lost"))).otherwise(F.lit("x")).alias("name"))
    with pytest.raises(PySparkException):
        table.overwrite(broken)
    assert table.version() == 1 and table.read().count() == 3 and table.read().columns == ["id", "v"]
    assert table.overwrite(frame(spark, [4]).select("id", F.lit("x").alias("name"))) == 2
    assert table.read().columns == ["id", "name"] and table.read(1).count() == 3


def test_partitions_follow_bytes(spark):
    assert [ly.partitions_for(b, 100) for b in (0, 1, 100, 101, 1000)] == [1, 1, 1, 2, 10]
    df = spark.range(1000).repartition(8)
    assert ly.resized(df, 300, 100, now=8).rdd.getNumPartitions() == 3 and ly.resized(df, 900, 100, now=8).rdd.getNumPartitions() == 9
    report = ly.partition_report(ly.resized(df, 500, 100), ["id"]).collect()
    assert sum(r.n_rows for r in report) == 1000 and sum(r.sum_id for r in report) == 499500 and max(r.n_rows for r in report) < 400


def test_paths_are_counted_not_listed(spark):
    # 20 diamonds in a row: 2**20 paths
    edges = [(3 * i + a, 3 * i + b) for i in range(20) for a, b in ((0, 1), (0, 2), (1, 3), (2, 3))]
    got = {r.node: (r.min_level, r.n_paths) for r in jn.reachable(spark.createDataFrame([*edges, (None, 4), (7, None)], "src int, dst int"), 0, 40).collect()}
    assert got[60] == (40, 2 ** 20) and got[3] == (2, 2) and len(got) == 60
    loop = spark.createDataFrame([(1, 2), (2, 1), (2, 1)], "src int, dst int")
    assert {r.node: (r.min_level, r.n_paths) for r in jn.reachable(loop, 1, 4).collect()} == {2: (1, 3), 1: (2, 6)}
    assert jn.reachable(loop, 9).collect() == []


def test_least_squares_equals_numpy_and_keeps_null_rows(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    x = rng.integers(0, 50, (200, 3))
    y = 3 + x @ np.array([2, -1, 5]) + rng.integers(0, 7, 200)
    rows = [(*map(float, a), float(b)) for a, b in zip(x, y)] + [(None, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double")
    m = ml.fit_linear(df, ["a", "b", "c"], "y")
    w, sse, *_ = np.linalg.lstsq(np.c_[np.ones(200), x], y, rcond=None)
    assert np.allclose([m.intercept, *m.coefficients], w) and m.n == 200 and np.isclose(m.mse, sse[0] / 200)
    got = ml.score_linear(df, m).collect()
    assert len(got) == 201 and sum(r.prediction is None for r in got) == 1
    same = ml.fit_linear(df.withColumn("b", F.col("a") * 2), ["a", "b"], "y")
    assert all(np.isnan(c) for c in same.coefficients)
    assert ml.fit_linear(df.limit(0), ["a"], "y").n == 0


def test_a_code_of_two_groups_belongs_to_the_smaller(spark):
    lookup = spark.createDataFrame([(1, "b"), (1, "a"), (2, "b"), (3, "a")], "code long, grp string")
    for _ in range(3):
        assert {r.code: r._rep for r in snap.code_map(lookup.repartition(4), "code", "grp").collect()} == {1: 1, 2: 1, 3: 1}


def test_variance_of_a_zero_average_is_null(spark, tmp_path):
    from tidemark.plans.changes_quality import QUERIES
    import datetime as dt
    rows = [(i, dt.datetime(2024, 1, 1 + i), 1, "purchase", 0.0 if i < 3 else 5.0, "{}") for i in range(5)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    got = {r.day.day: (r.variance_pct, r.is_alert) for r in QUERIES["revenue_variance"](spark, str(tmp_path)).collect()}
    assert got[2] == (None, False) and got[4] == (None, False) and got[5][1]
