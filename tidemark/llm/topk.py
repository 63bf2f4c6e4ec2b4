"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are dealt by length into buckets of at most ``BUCKET`` rows, longest
first. A query's scores in the longest bucket give a lower bound for its k-th
best score. Bucket b can be skipped when ``|q| * (longest of b)`` stays below
that bound; otherwise the bound gives a local cosine threshold ``t = bound /
(|q| * longest)``, and each query chooses its pruning in that bucket: with
``t >= COORDINATE_FROM`` coordinate pruning (candidates whose largest query
coordinates lie outside the feasible range are dropped), else length pruning
(candidates shorter than ``bound / |q|``). What is left is scored exactly; a
task merges the best k of its buckets per query, which raises the bound for the
next ones, and the tasks' best are merged.

Queries meet candidates in blocks, each pair of blocks in one row of a join, so
no task holds more than two blocks. Scores are integers and exact: float64
products serve blocks whose length product is below 2**53, 64-bit integers
larger ones. A score of a pair looked at that may not fit in 64 bits is an
error, and so is a scaled component of 2**63 or more. Vectors that are NULL, empty, or hold NULL or
non-finite components take no part, nor do rows without an id; only vectors of
the same dimension meet; rows with a query's id are its own. Repeated query
rows each get their results, so they repeat.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.runs import cut_runs, pack_runs, slices
from tidemark.session import broadcast_if_small, materialize

BUCKET = 8192
QUERY_BLOCK = 512
COORDINATE_FROM = 0.8            # local cosine threshold from which coordinates prune better than lengths
FOCUS = 3                        # query coordinates looked at
HELD_BLOCKS = 64                 # query blocks whose best a task keeps while it goes through buckets
_BLOCK = "block long, dim int, longest double, ids binary, lengths binary, vecs binary"


def _blocks_of(rows: DataFrame, most: int) -> DataFrame:
    """Rows of one dimension and component width in blocks of ``most``, longest
    first. Places are counted over all partitions, so blocks are full however
    the rows were dealt."""
    keyed = rows.select((F.col("dim") * 2 + (F.octet_length("vec") == F.col("dim") * 8).cast("int")).cast("long").alias("key"), (-F.col("length")).alias("down"),
                        F.xxhash64("id").alias("h"), "id", "length", "vec", (F.octet_length("vec") + 16).cast("long").alias("width"))

    def record(batch):
        names = batch.schema.names
        ids, lengths, vecs, width = (batch.column(names.index(c)) for c in ("id", "length", "vec", "width"))
        width = width.to_numpy()
        out, cut = [], np.flatnonzero(np.diff(width)) + 1
        for a, b in zip(np.append(0, cut).tolist(), np.append(cut, len(width)).tolist()):
            x = np.empty((b - a, int(width[a])), np.uint8)
            x[:, :8] = ids[a:b].to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8)
            x[:, 8:16] = lengths[a:b].to_numpy().astype("<f8").view(np.uint8).reshape(-1, 8)
            x[:, 16:] = np.frombuffer(b"".join(vecs[a:b].to_pylist()), np.uint8).reshape(b - a, -1)
            out.append(x.reshape(-1))
        return np.concatenate(out)

    # the id's hash in the order splits a length that very many rows share
    pieces = pack_runs(keyed, ["key", "down", "h"], record, "width", most, "topk-pieces")
    cut = cut_runs(pieces, ["key", "width"], most, "width", "at")

    def unpack(batches):
        for batch in batches:
            for key, width, at, data in zip(*(batch.column(i) for i in range(4))):
                key, width, at = key.as_py(), width.as_py(), at.as_py()
                x = np.frombuffer(data.as_buffer(), np.uint8).reshape(-1, width)
                lengths = np.ascontiguousarray(x[:, 8:16]).view("<f8").reshape(-1)
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([(key << 40) + at], pa.int64()), "dim": pa.array([key // 2], pa.int32()), "longest": pa.array([float(lengths[0])]),
                    "ids": pa.array([x[:, :8].tobytes()], pa.binary()), "lengths": pa.array([lengths.tobytes()], pa.binary()),
                    "vecs": pa.array([x[:, 16:].tobytes()], pa.binary())})

    return cut.select("key", "width", "at", "data").mapInArrow(unpack, _BLOCK)


def _matrix(raw: bytes, dim: int, rows: int) -> np.ndarray:
    return np.frombuffer(raw, np.int64 if len(raw) == 8 * dim * rows else np.int32).reshape(-1, dim).astype(np.float64)


def _products(q: np.ndarray, c: np.ndarray, reach: float, own: np.ndarray) -> np.ndarray:
    """Exact inner products, up to ``reach`` in size; those of ``own`` pairs do not count."""
    x = q @ c.T
    if reach < 2.0 ** 53 * (1 - 1e-9):
        return x
    if ((np.abs(x) + reach * 1e-12 >= 2.0 ** 63) & ~own).any():
        raise ValueError("a score may pass 64 bits")
    return q.astype(np.int64) @ c.astype(np.int64).T         # sums modulo 2**64, so only the result has to fit


def bound_of(scores: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """The k-th best score of each row, -inf with fewer than k candidates."""
    scores = np.where(own, -np.inf, scores)
    if scores.shape[1] < k:
        return np.full(len(scores), -np.inf)
    return -np.partition(-scores, k - 1, axis=1)[:, k - 1]


def survivors(query: np.ndarray, q_len: float, bound: float, vecs: np.ndarray, lengths: np.ndarray, longest: float) -> np.ndarray:
    """Candidates (descending length) that can still reach ``bound``."""
    if bound <= 0 or not np.isfinite(bound) or q_len == 0:
        return np.arange(len(lengths))
    t = bound / (q_len * longest) if longest else np.inf
    if t > 1 + 1e-9:
        return np.zeros(0, np.int64)
    near = np.searchsorted(-lengths, -(bound / q_len) * (1 - 1e-9), side="right")
    if t < COORDINATE_FROM:
        return np.arange(near)
    left, unit = np.arange(near), query / q_len
    turn = np.arccos(min(t, 1.0))                      # the largest angle to the query
    for f in np.argsort(-np.abs(unit), kind="stable")[:FOCUS]:
        angle = np.arccos(np.clip(unit[f], -1, 1))
        low, high = np.cos(min(angle + turn, np.pi)), np.cos(max(angle - turn, 0.0))
        share = vecs[left, f] / lengths[left]
        left = left[(share >= low - 1e-9) & (share <= high + 1e-9)]
    return left


def top_k(rows: DataFrame, k: int, is_query: Column, scale: float = 64.0, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best other rows by
    the inner product of ``floor(scale * x)``, ties to the smaller id."""
    spark = rows.sparkSession
    x = rows.select(F.col(id_col).cast("long").alias("id"), is_query.alias("q"), F.col(vec_col).alias("v")).where("id IS NOT NULL")

    def quantise(batches):
        for batch in batches:
            v = batch.column(2)
            if not batch.num_rows:
                continue
            v = v.filter(v.is_valid()) if v.null_count else v
            own = batch.filter(batch.column(2).is_valid()) if batch.column(2).null_count else batch
            size = v.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = v.flatten()
            raw = flat.to_numpy(zero_copy_only=False).astype(np.float64)             # NULL becomes NaN
            at = np.append(0, np.cumsum(size))
            wrong = np.append(0, np.cumsum(~np.isfinite(raw)))
            ok = (size > 0) & (wrong[at[1:]] == wrong[at[:-1]])
            if not ok.any():
                continue
            z = np.floor(raw[np.repeat(ok, size)] * scale)
            size, start = size[ok], np.append(0, np.cumsum(size[ok]))[:-1]
            ids, asked = own.column(0).to_numpy()[ok], own.column(1).fill_null(False).to_numpy(zero_copy_only=False)[ok]
            largest = np.maximum.reduceat(np.abs(z), start)
            if (largest >= 2.0 ** 63).any():
                raise ValueError(f"vector {ids[np.argmax(largest)]} has a scaled component that passes 64 bits")
            length = np.sqrt(np.add.reduceat(z * z, start))
            for some, kind in ((largest < 2 ** 31, np.int32), (largest >= 2 ** 31, np.int64)):
                if some.any():
                    vec = z[np.repeat(some, size)].astype(kind)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[some]), pa.array(asked[some]), pa.array(size[some].astype(np.int32)), pa.array(length[some]),
                         slices(vec, np.append(0, np.cumsum(size[some])) * vec.itemsize)], names=["id", "q", "dim", "length", "vec"])

    packed = materialize(x.mapInArrow(quantise, "id long, q boolean, dim int, length double, vec binary"), "topk-vectors")
    buckets = materialize(_blocks_of(packed.drop("q"), BUCKET), "topk-buckets")
    asked = _blocks_of(packed.where("q").drop("q"), QUERY_BLOCK)
    # one bucket per dimension, each of at most BUCKET rows; written, so that its size is known
    seeds = buckets.groupBy("dim").agg(F.max_by(F.struct("ids", "vecs", "longest"), F.struct("longest", -F.col("block"))).alias("s"))
    seeds = broadcast_if_small(materialize(seeds, "topk-seeds"))

    def bounds(batches):
        for batch in batches:
            need, bound = [], []
            for r in batch.to_pylist():
                qid, cid = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["s"]["ids"], np.int64)
                q, c = _matrix(r["vecs"], r["dim"], len(qid)), _matrix(r["s"]["vecs"], r["dim"], len(cid))
                reach = r["longest"] * r["s"]["longest"]
                own = qid[:, None] == cid[None, :]
                b = bound_of(_products(q, c, reach, own), own, k)
                if reach >= 2.0 ** 52:                       # a rounded score must not lie above the true one
                    b = b - np.abs(np.where(np.isfinite(b), b, 0)) * 1e-12
                length = np.frombuffer(r["lengths"], np.float64)
                with np.errstate(divide="ignore", invalid="ignore"):
                    least = np.where((b > 0) & (length > 0), b / length, 0.0)
                need.append(float(least.min()) * (1 - 1e-9))
                bound.append(b.tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(need, pa.float64()), pa.array(bound, pa.binary())],
                                             names=[*batch.schema.names[:6], "need", "bound"])

    # a row pair holds two blocks, so an Arrow batch takes few of them
    asked = materialize(asked.join(seeds, "dim").select("block", "dim", "longest", "ids", "lengths", "vecs", "s")
                        .mapInArrow(bounds, _BLOCK + ", need double, bound binary"), "topk-queries")
    meta = buckets.select(F.col("block").alias("bucket"), "dim", F.col("longest").alias("reach"))
    pairs = asked.select("block", "dim", "need").join(meta, "dim").where("reach >= need").select("block", "bucket")
    met = pairs.join(asked.select("block", "dim", F.col("ids").alias("qid"), F.col("lengths").alias("qlen"), F.col("vecs").alias("q"), "bound"), "block") \
        .join(buckets.select(F.col("block").alias("bucket"), "longest", "ids", "lengths", "vecs"), "bucket") \
        .select("block", "dim", "qid", "qlen", "q", "bound", "longest", "ids", "lengths", "vecs")

    def best(batches):
        held: dict[int, list] = {}                       # by query block: ids of its queries, and the best of the buckets so far

        def out():
            for block, (qid, at, ids, score) in held.items():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), block)), pa.array(at.astype(np.int32)), pa.array(qid[at]), pa.array(ids), pa.array(score)],
                                                 names=["block", "at", "query_id", "vec_id", "score"])
            held.clear()

        for batch in batches:
            for i in range(batch.num_rows):
                block, dim, qid, qlen, q, bound, longest, ids, lengths, vecs = (batch.column(j)[i].as_py() for j in range(10))
                qid, qlen, bound = np.frombuffer(qid, np.int64), np.frombuffer(qlen, np.float64), np.frombuffer(bound, np.float64)
                ids, lengths = np.frombuffer(ids, np.int64), np.frombuffer(lengths, np.float64)
                q, c = _matrix(q, dim, len(qid)), _matrix(vecs, dim, len(ids))
                if block not in held:
                    if len(held) >= HELD_BLOCKS:
                        yield from out()
                    z = np.zeros(0, np.int64)
                    held[block] = [qid, z, z, z]
                _, at, near, score = held[block]
                if len(at):                              # what earlier buckets hold raises the bound
                    full = np.bincount(at, minlength=len(q)) >= k
                    kth = np.full(len(q), np.iinfo(np.int64).max)
                    np.minimum.at(kth, at, score)
                    bound = np.where(full, np.maximum(bound, kth.astype(np.float64) * (1 - np.sign(kth) * 1e-12)), bound)
                parts = [(at, near, score)]
                left = [survivors(q[j], qlen[j], bound[j], c, lengths, longest) for j in range(len(q))]
                reach = float(qlen.max()) * longest
                dense = np.array([len(s) * 4 > len(ids) for s in left], bool)
                many = _products(q[dense], c, reach, qid[dense][:, None] == ids[None, :]) if dense.any() else None
                row = np.cumsum(dense) - 1
                for j, s in enumerate(left):
                    s = s[ids[s] != qid[j]]
                    x = many[row[j]][s] if dense[j] else _products(q[j:j + 1], c[s], reach, np.bool_(False))[0]
                    ok = x >= bound[j]
                    s, x = s[ok], x[ok]
                    if len(s) > k:
                        ok = x >= -np.partition(-x, k - 1)[k - 1]
                        s, x = s[ok], x[ok]
                    parts.append((np.full(len(s), j), ids[s], x.astype(np.int64)))
                at, near, score = (np.concatenate([p[n] for p in parts]) for n in range(3))
                order = np.lexsort((near, -score, at))
                at, near, score = at[order], near[order], score[order]
                first = np.searchsorted(at, at)
                keep = np.arange(len(at)) - first < k
                held[block][1:] = [at[keep], near[keep], score[keep]]
        yield from out()

    found = met.mapInArrow(best, "block long, at int, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("block", "at").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
