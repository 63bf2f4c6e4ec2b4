"""Custom keyed state with event-time timers: spells of activity per key.

A spell is a run of events of a key with gaps of at most ``gap`` between them.
Keys are dealt to hash buckets. State holds the open spells of a bucket's keys;
a timer at the end of the earliest one's gap gives out those that the watermark
has passed and drops them. Nothing depends on the wall clock, on how the input
is cut into batches or on the number of buckets, and state is bounded by the
watermark: spells of a key lie more than a gap apart.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.operators.layout import partitions_for

ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
SPELL = "key bigint, first bigint, last bigint, event_count bigint"
OPEN = "spells binary"           # key, first, last and event_count of each open spell as 64-bit integers, column after column
BUCKETS = 1024
BUCKET_BYTES = 256 * 1024


def spell_buckets(total_bytes: int) -> int:
    """Buckets for an input of about ``total_bytes``: one call then takes about
    as many rows whatever the input."""
    return max(BUCKETS, partitions_for(total_bytes, BUCKET_BYTES))


def merged(spells: np.ndarray, gap: int) -> np.ndarray:
    """The spells that spells and single events come down to, by key and first
    event; rows: key, first, last, events."""
    spells = spells[:, np.lexsort((spells[1], spells[0]))]
    key, first, last, n = spells
    many = len(key)
    if not many:
        return spells
    fresh = np.append(True, key[1:] != key[:-1])
    # the last event so far of the key: the greatest rank among its rows, above all ranks of the keys before
    order = np.argsort(last, kind="stable")
    rank = np.empty(many, np.int64)
    rank[order] = np.arange(many)
    base = np.cumsum(fresh) * many
    seen = last[order[np.maximum.accumulate(base + rank) - base]]
    fresh[1:] |= first[1:] - seen[:-1] > gap
    at = np.flatnonzero(fresh)
    return np.stack([key[at], first[at], seen[np.append(at[1:], many) - 1], np.add.reduceat(n, at)])


def _events(keys, times) -> np.ndarray:
    times = np.asarray(times, np.int64)
    return np.stack([np.broadcast_to(np.asarray(keys, np.int64), times.shape), times, times, np.ones(len(times), np.int64)])


def merge_spells(spells: list[tuple[int, int, int]], times: list[int], gap: int) -> list[tuple[int, int, int]]:
    """Open spells (first, last, events) of a key with further event times, in order."""
    held = np.asarray([(0, *s) for s in spells], np.int64).reshape(-1, 4).T
    return list(zip(*merged(np.concatenate([held, _events(0, times)], axis=1), gap)[1:].tolist()))


def close_time(last, gap: int):
    """The watermark (milliseconds) at which no event can join a spell any more."""
    return (last + gap) // 1000 + 1


def spell_step(gap: int) -> Callable:
    """One call per bucket and batch, with the open spells of the bucket's keys
    as its state: they travel with the rows, so neither a key nor a spell nor a
    timer costs a call or a request to the state store. A bucket has one timer,
    at the end of its earliest open spell."""
    def step(bucket, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        spells = np.frombuffer(state.get[0] if state.exists else b"", np.int64).reshape(4, -1)
        if not state.hasTimedOut:
            spells = merged(np.concatenate([spells, *(_events(pdf["key"], pdf["us"]) for pdf in rows)], axis=1), gap)
        now = state.getCurrentWatermarkMs()
        closes = close_time(spells[2], gap)
        still = closes > now
        if still.any():
            state.update((spells[:, still].tobytes(),))
            state.setTimeoutTimestamp(int(closes[still].min()))
        elif state.exists:
            state.remove()
        if not still.all():
            yield pd.DataFrame(dict(zip(("key", "first", "last", "event_count"), spells[:, ~still])))
    return step


def activity_spells(df: DataFrame, key: str, ts: str, gap_seconds: int, watermark: str, buckets: int = BUCKETS) -> DataFrame:
    """``key, spell_start, last_seen, event_count`` of every closed spell.
    ``ts`` is a TIMESTAMP; rows without one or without a key take no part. Run
    it with the settings ``ROCKSDB`` and output mode ``append``; ``buckets``
    stays the same as long as the checkpoint is used."""
    x = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).withWatermark(ts, watermark)
    x = x.select(F.col(key).cast("bigint").alias("key"), F.col(ts).alias("ts"), F.unix_micros(ts).alias("us"))
    x = x.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    out = x.groupBy("bucket").applyInPandasWithState(spell_step(gap_seconds * 1_000_000), SPELL, OPEN, "append", GroupStateTimeout.EventTimeTimeout)
    return out.select("key", F.timestamp_micros("first").alias("spell_start"), F.timestamp_micros("last").alias("last_seen"), "event_count")
