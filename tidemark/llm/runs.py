"""Rows of one key, in order, packed into pieces with their places.

A range-partitioned, sorted table is packed partition by partition. A key that
spans partitions gets its places from one count a partition, so no key is ever
gathered in one task, however many rows it has.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.textblocks import ragged
from tidemark.session import materialize


def slices(data: np.ndarray, at: np.ndarray) -> pa.Array:
    """Slices ``at[i]..at[i + 1]`` of a byte buffer as one binary column."""
    return pa.BinaryArray.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


def pack_runs(rows: DataFrame, order: list[str], record: Callable[[pa.RecordBatch], np.ndarray], width: int | str, most: int, name: str) -> DataFrame:
    """``<key>, first, n, data``: pieces of at most ``most`` rows of one key that
    follow one another in ``order``. The key (not NULL) is the first column of
    ``order``; ``first`` is the place of a piece's first row among its key's
    rows; ``data`` holds a record of ``width`` bytes for each row, which
    ``record`` makes of a batch as an array of bytes. ``width`` may also name a
    column, the same in all rows of a key, which the pieces keep."""
    key, kind = order[0], dict(rows.dtypes)[order[0]]
    arrow = {"bigint": pa.int64(), "string": pa.string()}[kind]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(key, *(c for c in rows.columns if c != key))

    kept = [width] if isinstance(width, str) else []

    def pack(batches):
        part, now, done, first = TaskContext.get().partitionId(), None, 0, None
        names = ["part", key, "first", "n", "data", "edge", *kept]
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(0).to_numpy(zero_copy_only=False)
            start = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            size = np.diff(np.append(start, len(own)))
            before = np.zeros(len(start), np.int64)          # rows of the key in earlier batches
            if own[0] == now:
                before[0] = done
            if first is None:
                first = [own[0], 0]
            if own[0] == first[0]:
                first[1] += int(size[0])
            now, done = own[-1], int(before[-1] + size[-1])
            pieces = -(-size // most)
            turn, run = ragged(np.zeros(len(size), np.int64), pieces), np.repeat(np.arange(len(size)), pieces)
            bytes_of = batch.column(batch.schema.names.index(width)).to_numpy().astype(np.int64) if kept else np.full(len(own), width)
            at = np.append(0, np.cumsum(bytes_of))[np.append(start[run] + turn * most, len(own))]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(run), part, np.int32)), pa.array(own[start][run], arrow), pa.array(before[run] + turn * most),
                pa.array(np.minimum(most, size[run] - turn * most)), slices(record(batch), at), pa.array(np.zeros(len(run), bool)),
                *(pa.array(bytes_of[start][run]) for _ in kept)], names=names)
        if first is not None:
            ends = dict([first, (now, done)])                # its first and last key may go on elsewhere
            yield pa.RecordBatch.from_arrays([
                pa.array([part] * len(ends), pa.int32()), pa.array(list(ends), arrow), pa.array([0] * len(ends), pa.int64()),
                pa.array(list(ends.values()), pa.int64()), pa.nulls(len(ends), pa.binary()), pa.array([True] * len(ends)),
                *(pa.nulls(len(ends), pa.int64()) for _ in kept)], names=names)

    packed = materialize(dealt.mapInArrow(pack, f"part int, {key} {kind}, first long, n long, data binary, edge boolean" + "".join(f", {c} long" for c in kept)), name)
    earlier = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = packed.where("edge").select(key, "part", F.sum("n").over(earlier).alias("earlier")).where("earlier IS NOT NULL")
    # bounded: at most two rows a partition
    return packed.where("NOT edge").drop("edge").join(F.broadcast(offsets), [key, "part"], "left") \
        .select(key, (F.col("first") + F.coalesce("earlier", F.lit(0))).alias("first"), "n", "data", *kept)


def cut_runs(pieces: DataFrame, keys: list[str], size: int, width: int | str, into: str) -> DataFrame:
    """Pieces of ``pack_runs`` dealt anew: one row ``<keys>, <into>, data`` for
    each ``size`` rows of a key, numbered by ``into``."""
    cut = pieces.withColumn(into, F.explode(F.expr(f"sequence(first div {size}, greatest(first, first + n - 1) div {size})")))
    cut = cut.withColumns({"since": F.greatest("first", F.col(into) * size), "until": F.least(F.col("first") + F.col("n"), (F.col(into) + 1) * size)})
    part = F.expr(f"substring(data, cast(since - first AS int) * {width} + 1, cast(until - since AS int) * {width})")
    # bounded: ``size`` records a group
    grouped = cut.select(*keys, into, F.struct("since", part.alias("data")).alias("p")).groupBy(*keys, into).agg(F.array_sort(F.collect_list("p")).alias("p"))
    return grouped.select(*keys, into, joined("p"))


def joined(pieces: str) -> Column:
    """The data of an array of pieces in one."""
    return F.aggregate(pieces, F.lit(b""), lambda x, y: F.concat(x, y["data"])).alias("data")
