"""Operator tests: invariants of the survey's test strategy, plan assertions
and the items checked only by pytest (T keys)."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from conftest import SF_SMALL
from tidemark.operators import changes as ch
from tidemark.operators import joins as jn
from tidemark.operators import layout as ly
from tidemark.operators import privacy as pv
from tidemark.operators import quality as q
from tidemark.operators import windows as win
from tidemark.session import scratch_path
from tidemark.sources import files as fs
from tidemark.sources.tables import tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- joins

def test_asof_join_matches_brute_force(spark):
    left = spark.createDataFrame([(1, 1, 10), (2, 1, 20), (3, 2, 5), (4, 3, 7)], "id int, k int, t int")
    right = spark.createDataFrame([(1, 5, 100.0), (1, 10, 110.0), (1, 15, 115.0), (2, 6, 200.0), (3, 8, 300.0)],
                                  "k int, rt int, v double")
    got = {r.id: r.v for r in jn.asof_join(left, right, ["k"], "t", "rt", ["v"], bucket=None).collect()}
    assert got == {1: 110.0, 2: 115.0, 3: None, 4: None}   # equal time matches; none before -> NULL


def test_asof_join_across_day_buckets(spark):
    import random
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    lrows = [(i, rnd.randint(0, 3), base + dt.timedelta(hours=rnd.randint(0, 24 * 6))) for i in range(300)]
    rrows = [(rnd.randint(0, 3) if i % 17 else None, base + dt.timedelta(hours=rnd.randint(0, 24 * 6), minutes=i),
              i, float(i)) for i in range(120)]
    left = spark.createDataFrame(lrows, "id int, k int, t timestamp")
    right = spark.createDataFrame(rrows, "k int, rt timestamp, seq int, v double")
    got = {r.id: r.v for r in jn.asof_join(left, right, ["k"], "t", "rt", ["v"], tiebreak="seq",
                                           bucket="day").collect()}
    exp = {}
    for i, k, t in lrows:
        cands = [(rt, seq, v) for kk, rt, seq, v in rrows if kk == k and rt <= t]
        exp[i] = max(cands)[2] if cands else None
    assert got == exp


def test_range_join_matches_nested_loop(spark):
    facts = spark.createDataFrame([(i, dt.date(2024, 1, 1) + dt.timedelta(days=i * 7)) for i in range(30)],
                                  "id int, d date")
    ranges = spark.createDataFrame([("a", dt.date(2024, 1, 10), dt.date(2024, 3, 5)),
                                    ("b", dt.date(2024, 2, 1), dt.date(2024, 2, 1)),
                                    ("c", dt.date(2024, 5, 20), dt.date(2024, 7, 2))], "r string, s date, e date")
    got = jn.range_join(facts, ranges, "d", "s", "e").select("id", "r")
    brute = facts.crossJoin(ranges).where(F.col("d").between(F.col("s"), F.col("e"))).select("id", "r")
    assertDataFrameEqual(got, brute)
    assert "CartesianProduct" not in plan(got) and "BroadcastNestedLoopJoin" not in plan(got)


def test_broadcast_join_plan(spark):
    t = tables(spark, SF_SMALL)
    j = jn.lookup_join(t.customer, t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    assert "BroadcastHashJoin" in plan(j)


def test_global_rank_matches_window(spark):
    import random
    rnd = random.Random(7)
    df = spark.createDataFrame([(i, float(rnd.randint(0, 40))) for i in range(500)], "id int, v double")
    for dense in (False, True):
        got = win.global_rank(df, "v", descending=True, dense=dense, out="r", partitions=6)
        f = F.dense_rank() if dense else F.rank()
        exp = df.withColumn("r", f.over(Window.orderBy(F.col("v").desc())))
        assertDataFrameEqual(got.select("id", "r"), exp.select("id", "r"))


# ---------------------------------------------------------------- changes

def _tgt_src(spark):
    t = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", 30)], "id int, name string, n int")
    s = spark.createDataFrame([(2, "B", 21), (4, "d", 40)], "id int, name string, n int")
    return t, s


def test_merge_upsert_and_idempotence(spark):
    t, s = _tgt_src(spark)
    once = ch.merge(t, s, ["id"])
    assert sorted(map(tuple, once.collect())) == [(1, "a", 10), (2, "B", 21), (3, "c", 30), (4, "d", 40)]
    assertDataFrameEqual(ch.merge(once, s, ["id"]), once)
    only_name = ch.merge(t, s, ["id"], update=["name"], insert=False)
    assert sorted(map(tuple, only_name.collect())) == [(1, "a", 10), (2, "B", 20), (3, "c", 30)]


def test_merge_with_separate_update_and_insert_columns(spark):
    t, s = _tgt_src(spark)
    s = s.withColumnRenamed("name", "label")
    out = ch.merge(t, s, ["id"], update={"name": "label"}, insert={"n": F.col("n") * 2})
    assert sorted(map(tuple, out.collect())) == [(1, "a", 10), (2, "B", 20), (3, "c", 30), (4, None, 80)]
    nulls = s.withColumn("label", F.lit(None).cast("string"))
    assert {r.id: r.name for r in ch.merge(t, nulls, ["id"], update={"name": "label"}, insert=False).collect()} == {1: "a", 2: None, 3: "c"}


def test_email_domains(spark):
    from tidemark.operators import privacy as pv
    df = spark.createDataFrame([("a@B.example",), ("none",), (None,), ("x@y@z.org",)], "e string")
    assert [r.d for r in pv.generalize(df, domains={"d": "e"}).collect()] == ["b.example", None, None, "z.org"]


def test_merge_rejects_duplicate_source_keys(spark):
    t, _ = _tgt_src(spark)
    dup = spark.createDataFrame([(2, "x", 1), (2, "y", 2)], "id int, name string, n int")
    with pytest.raises(Exception, match="duplicate source key"):
        ch.merge(t, dup, ["id"]).collect()


def test_insert_only_adds_unseen_keys(spark):
    t, s = _tgt_src(spark)
    out = jn.insert_only(t, s.unionByName(s), ["id"])
    assert sorted(r.id for r in out.collect()) == [1, 2, 3, 4]
    assert out.where("id = 2").first().name == "b"


def test_change_feed_reconstructs_after(spark):
    t, s = _tgt_src(spark)
    after = ch.merge(t, s, ["id"]).where("id <> 1")
    feed = ch.change_feed(t, after, ["id"])
    kinds = {(r.id, r._change_type) for r in feed.collect()}
    assert kinds == {(1, "delete"), (2, "update_preimage"), (2, "update_postimage"), (4, "insert")}
    # applying the feed to `before` gives `after`
    applied = (t.join(feed.where("_change_type IN ('delete', 'update_preimage')").select("id"), "id", "left_anti")
               .unionByName(feed.where("_change_type IN ('insert', 'update_postimage')").drop("_change_type")))
    assertDataFrameEqual(applied, after)


def test_as_of_latest_equals_current(spark):
    feed = spark.createDataFrame(
        [(1, 1, "a", "insert"), (2, 1, "b", "insert"), (1, 2, "a2", "update_postimage"), (2, 3, None, "delete"),
         (3, 3, "c", "insert")], "id int, _version bigint, name string, _change_type string")
    cur = ch.as_of(feed, ["id"], 3).select("id", "name")
    assert sorted(map(tuple, cur.collect())) == [(1, "a2"), (3, "c")]
    v1 = ch.as_of(feed, ["id"], 1).select("id", "name")
    assert sorted(map(tuple, v1.collect())) == [(1, "a"), (2, "b")]
    back = ch.restore_diff(feed, ["id"], 1, ["name"])
    assert {(r.id, r._change_type) for r in back.collect()} == {
        (1, "update_preimage"), (1, "update_postimage"), (2, "insert"), (3, "delete")}


def test_purge_keeps_undated_rows(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 30)), (3, None)], "id int, d date")
    assert sorted(r.id for r in ch.purge(df, "d", 7, dt.date(2024, 1, 31)).collect()) == [2, 3]


# ---------------------------------------------------------------- quality

def test_quarantine_partitions_input(spark):
    ev = tables(spark, SF_SMALL).events
    rules = {"small": "value < 100", "k": "get_json_object(props, '$.k') IS NOT NULL"}
    good, bad = q.quarantine(ev, rules)
    assert good.count() + bad.count() == ev.count()
    assert good.join(bad, "event_id").count() == 0


def test_expect_observation_counts(spark):
    df = spark.createDataFrame([(1,), (None,), (5,)], "x int")
    out, obs = q.expect(df, {"x_small": "x < 3"})
    out.collect()
    assert obs.get == {"rows": 3, "x_small": 2}                 # NULL counts as a violation


def test_check_rules_and_validate_inputs(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "x int, s string")
    kept = q.check_rules(df, [("s_present", "s IS NOT NULL", "drop"), ("x_pos", "x > 0", "fail")])
    assert kept.count() == 1
    with pytest.raises(Exception, match="expectation failed"):
        q.check_rules(df, [("x_big", "x > 1", "fail")]).collect()
    probs = q.validate_inputs({"a": df, "b": df.where("false")}, {"a": ["x", "y"], "b": ["x"], "c": []})
    assert probs == ["a: missing columns ['y']", "b: empty", "c: missing"]


# ---------------------------------------------------------------- privacy

def test_mask_tiers_and_row_filter_default_deny(spark):
    df = spark.createDataFrame([("ab.cd@x.org", "EU"), ("zz@y.com", "US")], "email string, region string")
    tiers = df.select(pv.email_mask_tier(F.col("email"), ["pii_access"]).alias("a"),
                      pv.email_mask_tier(F.col("email"), ["masked_access"]).alias("b"),
                      pv.email_mask_tier(F.col("email"), []).alias("c")).collect()
    assert tiers[0].a == "ab.cd@x.org" and tiers[0].b == "ab***@x.org" and tiers[0].c == pv.REDACTED
    policy = {"global_access": "*", "eu": "EU"}
    assert pv.row_filter(df, "region", policy, ["nobody"]).count() == 0
    assert pv.row_filter(df, "region", policy, ["eu"]).count() == 1
    assert pv.row_filter(df, "region", policy, ["eu", "global_access"]).count() == 2


def test_pii_mask_text(spark):
    df = spark.createDataFrame([("call 555-123-4567 or mail jane.doe@corp.com, ssn 123-45-6789",)], "t string")
    out = pv.mask_pii(df, ["t"]).first().t
    assert out == "call 555-***-4567 or mail ja***@corp.***, ssn ***-**-****"


# ---------------------------------------------------------------- sources / layout

def test_enforce_schema(spark):
    df = spark.createDataFrame([(1, "a")], "x int, s string")
    assert fs.enforce_schema(df, df.schema) is df
    with pytest.raises(fs.SchemaMismatch):
        fs.enforce_schema(df.withColumn("x", F.col("x").cast("long")), df.schema)


def test_overwrite_replaces_schema(spark):
    path = scratch_path(spark, "overwrite-schema")
    spark.createDataFrame([(1, "a")], "x int, s string").write.mode("overwrite").parquet(path)
    spark.createDataFrame([(2.5,)], "y double").write.mode("overwrite").parquet(path)
    assert spark.read.parquet(path).columns == ["y"]


def test_repartition_coalesce_counts(spark):
    df = spark.range(1000)
    assert df.repartition(7).rdd.getNumPartitions() == 7
    assert df.repartition(7).coalesce(3).rdd.getNumPartitions() == 3


def test_bucketed_join_has_no_exchange(spark):
    from tidemark.plans.io_layout import bucketed_join_frame
    j = bucketed_join_frame(spark, SF_SMALL)
    p = plan(j)
    assert "SortMergeJoin" in p or "BroadcastHashJoin" in p
    if "SortMergeJoin" in p:
        assert "Exchange hashpartitioning" not in p


def test_pruned_scan_plan(spark):
    path = scratch_path(spark, "prune")
    tables(spark, SF_SMALL).events.write.mode("overwrite").partitionBy("event_type").parquet(path)
    r = ly.pruned_read(spark, path, (F.col("event_type") == "error") & (F.col("value") > 100)).select("event_id")
    p = plan(r)
    assert "PartitionFilters: [isnotnull(event_type" in p and "PushedFilters: [IsNotNull(value), GreaterThan(value,100.0)]" in p
    assert "ReadSchema: struct<event_id:bigint,value:double>" in p


def test_scan_prunes_columns_and_pushes_filters(spark):
    from __spark_entry__ import queries
    p = plan(queries()["scan_parquet"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)]" in p
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double>" in p


def test_zorder_shrinks_file_ranges(spark):
    li = tables(spark, "/root/testdata/sf0.01").lineitem.select(
        F.unix_date(F.to_date("l_shipdate")).alias("d"), "l_extendedprice")

    def avg_ranges(df):
        per = df.withColumn("p", F.spark_partition_id()).groupBy("p").agg(
            (F.max("d") - F.min("d")).alias("rd"), (F.max("l_extendedprice") - F.min("l_extendedprice")).alias("rp"))
        r = per.agg(F.avg("rd"), F.avg("rp")).first()
        return r[0], r[1]
    base = avg_ranges(li.repartition(8))
    z = avg_ranges(ly.zorder(li, ["d", "l_extendedprice"], 8))
    assert z[0] < base[0] and z[1] < base[1]


def test_compact_reduces_files(spark):
    import glob
    src, dst = scratch_path(spark, "small"), scratch_path(spark, "big")
    tables(spark, SF_SMALL).events.repartition(20).write.mode("overwrite").parquet(src)
    n = ly.compact(spark, src, dst, target_bytes=1 << 30)
    assert n == 1 and len(glob.glob(f"{dst}/*.parquet")) == 1
    assert spark.read.parquet(dst).count() == spark.read.parquet(src).count()


def test_clock_free_library():
    """Library code takes ``as_of`` parameters; no operator reads the clock."""
    import pathlib
    root = pathlib.Path(__file__).resolve().parents[1] / "tidemark" / "operators"
    for f in root.glob("*.py"):
        src = f.read_text()
        assert "current_date(" not in src and "date.today(" not in src, f.name


def test_keyed_dedupe_limits_before_shuffle(spark):
    """A hot key cannot pile up behind the exchange: each map task forwards at
    most one row per key (partial WindowGroupLimit below the Exchange)."""
    from tidemark.operators.snapshots import dedupe_keyed
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ev = tables(spark, SF_SMALL).events
        p = plan(dedupe_keyed(ev, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()]))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = p.splitlines()
    ex = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning(user_id" in l)
    assert any("WindowGroupLimit" in l and "Partial" in l for l in lines[ex:])
    assert any("WindowGroupLimit" in l and "Final" in l for l in lines[:ex])


def test_conform_broadcasts_bounded_code_map(spark):
    from tidemark.operators.snapshots import conform
    t = tables(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = t.part.select(F.col("p_size").cast("bigint").alias("PRIMARY_CAUSE_OF_LOSS_SK"), "p_partkey")
        out = conform(p, "PRIMARY_CAUSE_OF_LOSS_SK", t.cause_lookup(), "CAUSE_TYPE")
        assert "BroadcastHashJoin" in plan(out)       # by the proven row bound, not the size estimate
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_windows_match_plain_windows(spark):
    import random
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    # skewed keys, sparse and dense hours: frames of 10 rows span many buckets
    rows = [(i, rnd.choice([0, 0, 0, 0, 1, 2]), base + dt.timedelta(minutes=rnd.randint(0, 60 * 40)), rnd.randint(1, 99))
            for i in range(700)]
    df = spark.createDataFrame(rows, "id int, k int, ts timestamp, v int")
    hour = F.date_trunc("hour", "ts")
    got = win.prior_rows(df, ["k"], ["ts", "id"], "v", 10, bucket=hour)
    exp = win.prior_rows(df, ["k"], ["ts", "id"], "v", 10)
    assertDataFrameEqual(got.select("id", "_prior_sum", "_prior_cnt"), exp.select("id", "_prior_sum", "_prior_cnt"))
    rs = win.running_sum(df, ["k"], ["ts"], "v", "rt", bucket=hour)
    rs0 = win.running_sum(df, ["k"], ["ts"], "v", "rt")
    assertDataFrameEqual(rs.select("id", "rt"), rs0.select("id", "rt"))
    rn = win.row_numbers(df, ["k"], ["ts", "id"], "rn", bucket=hour)
    rn0 = win.row_numbers(df, ["k"], ["ts", "id"], "rn")
    assertDataFrameEqual(rn.select("id", "rn"), rn0.select("id", "rn"))


def test_datetime_literals_ignore_python_zone(spark):
    """Filters built from Python datetimes must not shift when the Python
    process runs in another zone than the session."""
    import os
    import time
    from __spark_entry__ import oracle_sql, queries
    from tidemark.plans.oracle_check import compare, duck
    old = os.environ.get("TZ")
    os.environ["TZ"] = "America/Los_Angeles"
    time.tzset()
    try:
        con = duck(SF_SMALL)
        for key in ("filter_rows", "parameterized_report", "freshness", "log_failures", "drift_score"):
            df = queries()[key](spark, SF_SMALL)
            res = con.execute(oracle_sql()[key])
            status, detail = compare(df.columns, [tuple(r) for r in df.collect()],
                                     [d[0] for d in res.description], res.fetchall())
            assert status == "OK", f"{key}: {detail}"
    finally:
        if old is None:
            os.environ.pop("TZ", None)
        else:
            os.environ["TZ"] = old
        time.tzset()


def test_operators_accept_empty_input(spark):
    from tidemark.operators import aggregates as agg
    from tidemark.operators import snapshots as snap
    ev = tables(spark, SF_SMALL).events.where("false")
    assert win.global_rank(ev, "value", out="r", by=["event_type"]).count() == 0
    assert agg.exact_percentiles(ev, "value", ["event_type"], {"p50": 0.5}).count() == 0
    assert win.prior_rows(ev, ["user_id"], ["ts", "event_id"], "value", 10, bucket=F.to_date("ts")).count() == 0
    assert win.running_sum(ev, ["user_id"], ["ts"], "value", "rt", bucket=F.to_date("ts")).count() == 0
    assert jn.asof_join(ev, ev.select("user_id", F.col("ts").alias("rt"), "value"), ["user_id"], "ts", "rt",
                        ["value"]).count() == 0
    e2 = ev.select("user_id", "value")
    assert ch.change_feed(e2, e2, ["user_id"]).count() == 0
    good, bad = q.quarantine(ev, {"pos": "value > 0"})
    assert good.count() == 0 and bad.count() == 0
    from tidemark.plans.snapshot import _bronze
    assert snap.gold_emergence(_bronze(spark, SF_SMALL).where("false"), "latest").count() == 0


def test_forest_is_trained_on_partitions_of_bounded_bytes(spark, monkeypatch):
    """The estimator's rows are far larger than the training rows: its partitions follow their own bytes."""
    from pyspark.ml.regression import RandomForestRegressor
    from tidemark.operators import ml
    fit, seen = RandomForestRegressor.fit, []

    def watched(self, data, *a):
        seen.append([r.n for r in data.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()])
        return fit(self, data, *a)

    monkeypatch.setattr(RandomForestRegressor, "fit", watched)
    monkeypatch.setattr(ml, "FOREST_BYTES", 1 << 20, raising=False)
    df = spark.range(20000).selectExpr("CAST(id % 50 AS DOUBLE) AS x", "CAST(id % 50 AS DOUBLE) * 2 AS y").union(spark.sql("SELECT CAST(NULL AS DOUBLE), 1D")).coalesce(1)
    model = ml.train_forest(df, ["x"], "y", num_trees=20)
    assert sum(seen[0]) == 20000 and len(seen[0]) >= 4 and max(seen[0]) * 260 < 2 << 20
    got = ml.score(spark.createDataFrame([(10.0,), (40.0,)], "x double"), model, ["x"]).orderBy("x").collect()
    assert abs(got[0].prediction - 20) < 5 and abs(got[1].prediction - 80) < 5
