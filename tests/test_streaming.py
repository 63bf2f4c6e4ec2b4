"""Streaming behaviour that a batch oracle cannot show: watermark drops,
triggers, restart from a checkpoint, batch/stream parity."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.session import scratch_path
from tidemark.sources.tables import tables
from tidemark.streaming import operators as so
from tidemark.streaming import runner as sr

SCHEMA = "id INT, ts TIMESTAMP_NTZ, v INT"


def test_watermark_drops_late_event(spark):
    """Watermark 10 minutes; an event 15 minutes behind the watermark is not
    aggregated (the practice-question answer).

    Spark filters late input with the watermark of the previous batch, so the
    late file is the third micro-batch: batch 0 moves the watermark to 12:25,
    batch 1 (on-time data) makes it the late-row threshold, batch 2 brings an
    event at 12:10.
    """
    import time
    src = scratch_path(spark, "wm-src")
    t0 = dt.datetime(2024, 1, 1, 12, 0)
    files = [[(i, t0 + dt.timedelta(minutes=i), 1) for i in range(0, 40, 5)],   # up to 12:35
             [(50, t0 + dt.timedelta(minutes=40), 1)],                           # on time
             [(99, t0 + dt.timedelta(minutes=10), 1)]]                           # 15 min behind 12:25
    for rows in files:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)  # the file source orders files by modification time
    s = sr.file_stream(spark, src, SCHEMA, max_files=1).transform(sr.event_time, "ts")
    agg = so.windowed(s, "ts", "10 minutes", watermark="10 minutes", aggs=[F.count(F.lit(1)).alias("n")])
    out = sr.run_stream(agg, "wm", "update", keys=["window_start"]).result()
    w1210 = out.where(F.col("window_start") == F.lit(t0 + dt.timedelta(minutes=10))).first()
    assert w1210.n == 2                              # 12:10 and 12:15 on time; the late 12:10 dropped


def test_processing_time_trigger_runs(spark):
    src = scratch_path(spark, "trig-src")
    spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 1)], SCHEMA).write.parquet(src)
    q = (sr.file_stream(spark, src, SCHEMA).writeStream.format("noop")
         .option("checkpointLocation", scratch_path(spark, "trig-ck"))
         .trigger(processingTime="1 second").start())
    q.processAllAvailable()
    assert q.isActive and q.lastProgress is not None
    q.stop()


def test_once_trigger_equivalent(spark):
    src = scratch_path(spark, "once-src")
    spark.createDataFrame([(i, dt.datetime(2024, 1, 1), i) for i in range(10)], SCHEMA).write.parquet(src)
    run = sr.run_stream(sr.file_stream(spark, src, SCHEMA), "once", trigger={"availableNow": True})
    assert run.result().count() == 10


def test_batch_stream_parity(spark):
    ev = tables(spark, SF_SMALL).events
    batch = ev.transform(so.features, "ts", "value").select("event_id", "amount_category", "hour_of_day")
    path, schema = sr.stage_files(ev, "parity", 4, "ts")
    s = sr.file_stream(spark, path, schema).transform(so.features, "ts", "value") \
        .select("event_id", "amount_category", "hour_of_day")
    out = sr.run_stream(s, "parity").result()
    assert out.exceptAll(batch).count() == 0 and batch.exceptAll(out).count() == 0


def test_left_outer_stream_join_keeps_inner_matches(spark):
    from __spark_entry__ import queries
    left = queries()["stream_stream_left"](spark, SF_SMALL)
    inner = queries()["stream_stream_inner"](spark, SF_SMALL)
    matched = left.where("view_id IS NOT NULL")
    assert matched.exceptAll(inner).count() == 0 and inner.exceptAll(matched).count() == 0


WATERMARKED = ["stream_tumbling", "stream_sliding", "stream_hourly", "stream_session", "stream_dedupe", "stream_end_to_end", "stream_stream_left"]


def test_watermarked_queries_do_not_depend_on_the_trigger_size(spark, monkeypatch):
    """All files in one batch, and one file a batch, give equal rows; the
    registered form runs in at least five batches with input."""
    from __spark_entry__ import queries
    plain, batches = sr.file_stream, []
    run = sr.run_stream

    def counted(*a, **k):
        got = run(*a, **k)
        batches.append(sum(p["numInputRows"] > 0 for p in got.progress))
        return got

    for name in WATERMARKED:
        monkeypatch.setattr(sr, "run_stream", counted)
        batches.clear()
        many = queries()[name](spark, SF_SMALL).collect()
        assert max(batches) >= 5, name
        monkeypatch.setattr(sr, "file_stream", lambda *a, **k: plain(*a, **{**k, "max_files": None}))
        batches.clear()
        one = queries()[name](spark, SF_SMALL).collect()
        monkeypatch.setattr(sr, "file_stream", plain)
        assert max(batches) == 1, name
        assert sorted(map(repr, many)) == sorted(map(repr, one)), name


def test_scoring_keeps_rows_with_null_features(spark):
    from tidemark.operators import ml
    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(20)], "x double, y double")
    model = ml.train_linear(df, ["x"], "y")
    got = ml.score(spark.createDataFrame([(1.0,), (None,)], "x double"), model, ["x"]).collect()
    assert [r.prediction is None for r in sorted(got, key=lambda r: r.x is None)] == [False, True]


CHANGES = "k INT, seq BIGINT, op STRING, v STRING"


def keyed(spark, path=None, buckets=3):
    from tidemark.streaming.upsert import KeyedSnapshot
    return KeyedSnapshot(spark, path or scratch_path(spark, "keyed"), ["k"], ["seq"], buckets)


def state(table):
    return {r.k: (r.seq, r.v) for r in table.read().collect()}


def test_upserts_of_several_batches_and_replays(spark):
    table = keyed(spark)
    first = spark.createDataFrame([(k, k, "U", "a") for k in range(20)] + [(0, 50, "U", "z"), (0, 7, "U", "old")], CHANGES)
    second = spark.createDataFrame([(1, 100, "D", None), (2, 1, "U", "too old"), (3, 100, "U", "new"), (99, 1, "U", "in"), (0, 50, "U", "same seq")], CHANGES)
    third = spark.createDataFrame([(1, 99, "U", "older than the delete"), (3, 101, "D", None), (99, 2, "U", "again")], CHANGES)
    for i, batch in enumerate((first, second, third)):
        assert table.apply(batch, i, "op = 'D'")
    want = {k: (k, "a") for k in range(4, 20)} | {2: (2, "a"), 0: (50, "same seq"), 99: (2, "again")}
    assert state(table) == want
    for i, batch in enumerate((first, second, third)):
        assert not table.apply(batch, i, "op = 'D'")              # replayed batches change nothing
    assert state(table) == want
    assert table.apply(first.limit(0), 3) and not table.apply(first, 3) and state(table) == want
    touched = {r._bucket for r in table.ledger().where("_batch = 2").collect()}
    assert len(touched) <= 3 and table.apply(spark.createDataFrame([(1, 200, "U", "back")], CHANGES), 4, "op = 'D'")
    assert state(table) == want | {1: (200, "back")}


def test_upsert_stream_restarts_in_the_middle(spark, monkeypatch):
    """A run that breaks off after a batch's rows were written, or after its
    ledger entry, goes on without losing or repeating a change."""
    import pytest
    from tidemark.streaming import upsert as up
    rows = [(i % 40, i, "D" if i % 11 == 0 else "U", str(i)) for i in range(400)]
    path, schema = sr.stage_files(spark.createDataFrame(rows, CHANGES), "keyed-src", 6, "seq")
    want = {}
    for k, seq, op, v in rows:
        want[k] = None if op == "D" else (seq, v)
    want = {k: v for k, v in want.items() if v}
    for stop in ("before", "after"):
        base, table = scratch_path(spark, "keyed"), keyed(spark)
        real, calls = up.KeyedSnapshot.apply, []

        def breaks(self, changes, batch_id, deletes=None):
            calls.append(batch_id)
            if len(calls) == 3:
                if stop == "after":
                    real(self, changes, batch_id, deletes)
                else:                                             # half a batch: folders without a ledger entry
                    changes.limit(1).withColumn("_deleted", F.lit(False)).withColumn("_bucket", F.lit(0)) \
                        .write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/state/_batch={batch_id}")
                raise RuntimeError("lost")
            return real(self, changes, batch_id, deletes)

        monkeypatch.setattr(up.KeyedSnapshot, "apply", breaks)
        stream = lambda: sr.file_stream(spark, path, schema, max_files=1)
        with pytest.raises(Exception, match="lost"):
            up.upsert_stream(stream(), table, f"{base}/checkpoint", "op = 'D'")
        assert state(table) != want
        up.upsert_stream(stream(), table, f"{base}/checkpoint", "op = 'D'")
        monkeypatch.setattr(up.KeyedSnapshot, "apply", real)
        assert state(table) == want, stop
        assert sorted(r._batch for r in table.ledger().select("_batch").distinct().collect()) == list(range(6))


def test_spells_merge_whatever_the_order():
    import random
    from tidemark.streaming.spells import merge_spells
    times = sorted(random.Random(1).sample(range(1000), 60))
    whole = merge_spells([], times, 15)
    for seed in range(5):
        shuffled, got = list(times), []
        random.Random(seed).shuffle(shuffled)
        for i in range(0, 60, 7):
            got = merge_spells(got, shuffled[i:i + 7], 15)
        assert got == whole
    assert merge_spells([], [0, 15, 31, 31], 15) == [(0, 15, 2), (31, 31, 2)]


def test_spells_do_not_depend_on_the_trigger_size(spark):
    from tidemark.streaming.spells import ROCKSDB, activity_spells
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i % 3, t0 + dt.timedelta(minutes=m), 0) for i, m in enumerate([0, 1, 2, 9, 5, 30, 31, 33, 60, 200, 201, 202, 290])] + [(None, t0, 0), (1, None, 0), (9, t0 + dt.timedelta(days=2), 0)]
    got = []
    for files in (1, None):
        path, schema = sr.stage_files(spark.createDataFrame(rows, SCHEMA), "spell-src", 3, "ts")
        s = sr.file_stream(spark, path, schema, max_files=files).transform(sr.event_time, "ts")
        out = sr.run_stream(activity_spells(s, "id", "ts", 600, "1 hour"), "spells", conf=ROCKSDB).result().where("key < 9")
        got.append(sorted((r.key, r.spell_start, r.last_seen, r.event_count) for r in out.collect()))
    assert got[0] == got[1] and sum(n for *_, n in got[0]) == 13


def test_open_spells_of_a_key_are_one_state(spark):
    """However many spells a batch opens, a key has one state with one timer."""
    from tidemark.streaming.spells import ROCKSDB, activity_spells
    t0 = dt.datetime(2024, 1, 1)
    rows = [(k, t0 + dt.timedelta(hours=h), 0) for k in range(4) for h in range(60)] + [(9, t0 + dt.timedelta(days=9), 0)]
    path, schema = sr.stage_files(spark.createDataFrame(rows, SCHEMA), "spell-src", 2, "ts")
    s = sr.file_stream(spark, path, schema, max_files=1).transform(sr.event_time, "ts")
    run = sr.run_stream(activity_spells(s, "id", "ts", 600, "1 hour"), "spells", conf=ROCKSDB)
    out = run.result().where("key < 9").collect()
    assert len(out) == 240 and all(r.event_count == 1 and r.spell_start == r.last_seen for r in out)
    assert 4 <= max(p["stateOperators"][0]["numRowsTotal"] for p in run.progress) <= 5


def test_spells_of_a_bucket_are_one_state_and_one_call(spark):
    """States come to the buckets, not the keys; spells do not depend on the number of buckets."""
    import random
    from tidemark.streaming.spells import ROCKSDB, activity_spells, spell_buckets
    t0, r = dt.datetime(2024, 1, 1), random.Random(3)
    rows = [(k, t0 + dt.timedelta(minutes=r.randrange(3000)), 0) for k in range(300) for _ in range(9)]
    rows += rows[:40] + [(-(1 << 63), t0 + dt.timedelta(days=9), 0)]
    want, by_key = [], {}
    for k, t, _ in sorted(rows[:-1]):
        last = by_key.get(k)
        if last and t - last[2] <= dt.timedelta(minutes=10):
            last[2:] = [t, last[3] + 1]
        else:
            by_key[k] = [k, t, t, 1]
            want.append(by_key[k])
    for buckets in (1, 7):
        path, schema = sr.stage_files(spark.createDataFrame(rows, SCHEMA.replace("id INT", "id BIGINT")), "spell-src", 3, "ts")
        s = sr.file_stream(spark, path, schema, max_files=1).transform(sr.event_time, "ts")
        run = sr.run_stream(activity_spells(s, "id", "ts", 600, "1 hour", buckets), "spells", conf=ROCKSDB)
        got = sorted([x.key, x.spell_start, x.last_seen, x.event_count] for x in run.result().where("key >= 0").collect())
        assert got == sorted(want)
        assert max(p["stateOperators"][0]["numRowsTotal"] for p in run.progress) <= buckets
    assert spell_buckets(0) == spell_buckets(1 << 20) < spell_buckets(1 << 40) // 1000


def test_progress_log_keeps_every_update(spark):
    from tidemark.streaming.progress import ProgressLog
    src = scratch_path(spark, "many-src")
    spark.range(2100).selectExpr("CAST(id AS INT) AS id", "TIMESTAMP_NTZ '2024-01-01' AS ts", "1 AS v").repartition(105).write.parquet(src)
    with ProgressLog(spark, scratch_path(spark, "many-log")) as log:
        run = sr.run_stream(sr.file_stream(spark, src, SCHEMA, max_files=1), "many")
        log.wait(run.run_id)
    rows = log.read().where("input_rows > 0").collect()
    assert len(run.progress) <= 100 < len(rows) and sum(r.input_rows for r in rows) == 2100
    assert len({r.batch_id for r in rows}) == len(rows)


def test_output_modes_emit_by_their_rules(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i % 4, t0 + dt.timedelta(hours=i), 1) for i in range(96)] + [(-1, t0 + dt.timedelta(days=30), 1)]
    path, schema = sr.stage_files(spark.createDataFrame(rows, SCHEMA), "mode-src", 4, "ts")
    want, keys = None, ["window_start", "id"]
    for mode in ("append", "update", "complete"):
        s = sr.file_stream(spark, path, schema, max_files=1).transform(sr.event_time, "ts")
        agg = so.windowed(s, "ts", "1 day", keys=["id"], watermark="1 hour", aggs=[F.count(F.lit(1)).alias("n")])
        rows = sr.emissions(agg, "modes", mode).where("id >= 0").cache()
        per_batch = {r["_batch"]: r["n"] for r in rows.groupBy("_batch").agg(F.count("*").alias("n")).collect()}
        once = rows.select(*keys).distinct().count()
        got = sorted(map(tuple, sr.settled(rows, mode, keys).select(*keys, "n").collect()))
        want = want or got
        assert got == want and once == 16
        if mode == "append":
            assert rows.count() == 16                             # each window once, when it is final
        elif mode == "complete":
            counts = [n for _, n in sorted(per_batch.items())]
            assert counts == sorted(counts) and counts[-1] == 16 and sum(counts) > rows.select(*keys).distinct().count()
        else:
            assert 16 <= rows.count() < sum(1 for _ in range(16 * 4))


def test_batches_come_in_order_with_several_files_each(spark):
    from tidemark.streaming.progress import ProgressLog
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(hours=i), i // 20) for i in range(80)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    with ProgressLog(spark, scratch_path(spark, "order-log")) as log:
        run, ids = sr.run_in_order(df.withColumn("b", F.col("v")), "b", lambda s: so.deduplicated(sr.event_time(s, "ts"), ["id"], "ts", "1 hour"), "order")
        for i in ids:
            log.wait(i)
    assert run.result().count() == 80 and len(ids) == 4
    assert [r.input_rows for i in ids for r in log.read().where(F.col("run_id") == i).where("input_rows > 0").collect()] == [20] * 4


def test_user_totals_cover_spells_left_open_over_batches(spark, tmp_path):
    """Many events of a key, open over the batch borders; rows without a key or a time take no part."""
    from __spark_entry__ import queries
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(minutes=(7 if k else 25) * i), k, "view", 1.0, "{}") for k in range(3) for i in range(50)]
    rows += [(900, None, 1, "view", 1.0, "{}"), (901, t0, None, "view", 1.0, "{}")] + rows[:5]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string") \
        .repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    got = {r.user_id: (r.event_count, r.last_seen) for r in queries()["stream_user_state"](spark, str(tmp_path)).collect()}
    last = [t0 + dt.timedelta(minutes=49 * m) for m in (25, 7, 7)]
    assert got == {0: (55, last[0]), 1: (50, last[1]), 2: (50, last[2])}
    spells = queries()["stream_user_spells"](spark, str(tmp_path)).groupBy("user_id").count().collect()
    assert {r.user_id: r["count"] for r in spells} == {0: 50, 1: 1, 2: 1}


def test_staged_files_grow_with_the_input_and_batches_do_not(spark, monkeypatch):
    """Parts of more than ``STAGED_BYTES`` are staged as several files; batches and rows stay the same."""
    from __spark_entry__ import queries
    plain, run, seen, batches = sr.stage_files, sr.run_stream, [], []

    def staged(df, name, n_files, *a, **k):
        seen.append(n_files)
        return plain(df, name, n_files, *a, **k)

    def counted(*a, **k):
        got = run(*a, **k)
        batches.append(sum(p["numInputRows"] > 0 for p in got.progress))
        return got

    monkeypatch.setattr(sr, "stage_files", staged)
    monkeypatch.setattr(sr, "run_stream", counted)
    for name in ("stream_pii_mask", "stream_tumbling", "stream_session"):
        rows, files, n = {}, {}, {}
        for size in (1 << 30, 4096):
            monkeypatch.setattr(sr, "STAGED_BYTES", size)
            seen.clear(), batches.clear()
            rows[size] = sorted(map(repr, queries()[name](spark, SF_SMALL).collect()))
            files[size], n[size] = seen[0], batches[0]
        assert rows[4096] == rows[1 << 30] and n[4096] == n[1 << 30], name
        assert files[1 << 30] == {"stream_pii_mask": 4}.get(name, 6) and files[4096] >= 2 * files[1 << 30], name
