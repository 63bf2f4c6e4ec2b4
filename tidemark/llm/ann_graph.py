"""Approximate nearest neighbours by robust-pruned directed graphs.

The distinct vectors are dealt by hash into shards of about ``SHARD`` rows, and
every shard becomes a directed graph. Vectors enter it in batches that double:
each looks for itself with a greedy search, and of all that the search has looked at, robust pruning keeps its neighbours: nearest
first, and a candidate goes if a kept one is nearer to it, even times
``RELAXED``, than the new vector. So short edges into several directions and
some long ones stay. Edges are entered both ways; a full list is pruned again.
Vectors that no path from the starts reaches become further starts, so every
row can be found.

A search starts from the middle and a few random entries (``entries``), so that
a large group of near copies around the middle does not hold it back. A query
goes through each shard with a beam search: the ``SEARCH_BEAM`` nearest seen so far
are kept, and the nearest not yet opened are opened, until all are. What the beam ends with is scored again by the exact cosine of the original vectors in double
precision, and the shards' best are merged.

Equal vectors are one entry that keeps its least k + 1 ids, which is all a result
of k can hold, so copies cost no recall. Vectors that are NULL, empty, all zero,
or hold NULL or non-finite components take no part, nor do rows without an id;
vectors meet only those of their dimension. Rows that repeat an id and its
vector count once; other rows with a query's id are its own. Other columns are not
read. An empty table, or one without queries, gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

SHARD = 16384
DEGREE = 32                      # edges of a vector
BEAM = 64                        # entries of a beam while a graph is built
SEARCH_BEAM = 128                # and of a query's beam
OPENED = 4                       # entries of a beam that are opened at a time
RELAXED = 1.2                    # how much nearer a kept neighbour has to be
BATCH = 512                      # vectors that enter a graph, or queries that go through it, at a time
_INDEX = "dim int, shard long, vecs binary, ids binary, held binary, edges binary, starts binary"


def directions(vecs: np.ndarray) -> np.ndarray:
    """Vectors of length 1 in single precision, from finite ones of any size."""
    x = vecs.astype(np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
    return (x / np.sqrt((x * x).sum(axis=1))[:, None]).astype(np.float32)


def cosines(query: np.ndarray, vecs: np.ndarray) -> np.ndarray:
    """Cosines of one vector with several in double precision; a row's result does not depend on the other rows."""
    def scaled(x):
        x = x.astype(np.float64)
        return np.ldexp(x, -np.frexp(np.abs(x).max(axis=-1, keepdims=True))[1])

    q, c = scaled(query), scaled(vecs)
    return (c * q).sum(axis=1) / (np.sqrt((q * q).sum()) * np.sqrt((c * c).sum(axis=1)))


def beam_search(x: np.ndarray, edges: np.ndarray, starts: np.ndarray, queries: np.ndarray, beam: int):
    """``(ids, distances, opened)`` of the beams after the search: entries and
    squared distances, -1 and infinity where a beam is not full; ``opened``: a
    list of (rows, entries, distances) of all that was opened."""
    b = len(queries)
    ids, dist, shut = np.full((b, beam), -1), np.full((b, beam), np.inf, np.float32), np.zeros((b, beam), bool)
    seen = np.zeros((b, len(x)), bool)
    opened = []

    def enter(rows, found, new):
        """Merge candidates (-1: none) into the beams of rows."""
        diff = x[found] - queries[rows][:, None, :]
        d = np.where(new, np.einsum("ijk,ijk->ij", diff, diff), np.inf).astype(np.float32)
        all_ids = np.concatenate([ids[rows], np.where(new, found, -1)], axis=1)
        all_d = np.concatenate([dist[rows], d], axis=1)
        all_shut = np.concatenate([shut[rows], np.zeros(d.shape, bool)], axis=1)
        best = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
        ids[rows], dist[rows], shut[rows] = (np.take_along_axis(a, best, 1) for a in (all_ids, all_d, all_shut))

    every = np.arange(b)
    for a in range(0, len(starts), DEGREE):
        some = np.broadcast_to(starts[a:a + DEGREE], (b, len(starts[a:a + DEGREE])))
        seen[every[:, None], some] = True
        enter(every, some, np.ones(some.shape, bool))
    while True:
        cost = np.where(shut, np.inf, dist)
        pick = np.argpartition(cost, OPENED - 1, axis=1)[:, :OPENED]
        ok = np.isfinite(np.take_along_axis(cost, pick, 1))
        rows = np.flatnonzero(ok.any(axis=1))
        if not len(rows):
            return ids, dist, opened
        pick, ok = pick[rows], ok[rows]
        at = rows[:, None]
        node = np.where(ok, ids[at, pick], -1)
        opened.append((rows, node, dist[at, pick]))
        shut[at, pick] |= ok
        found = np.where(ok[:, :, None], edges[node], -1)
        new = np.empty(found.shape, bool)
        for j in range(found.shape[1]):                  # in turn, as two opened entries may lead to the same one
            new[:, j] = (found[:, j] >= 0) & ~seen[at, found[:, j]]
            r, c = np.nonzero(new[:, j])
            seen[rows[r], found[r, j, c]] = True
        enter(rows, found.reshape(len(rows), -1), new.reshape(len(rows), -1))


def robust_prune(x: np.ndarray, found: np.ndarray, dist: np.ndarray, degree: int) -> np.ndarray:
    """At most ``degree`` of each row's candidates (-1: none; squared distances)."""
    order = np.argsort(dist, axis=1, kind="stable")
    found, dist = np.take_along_axis(found, order, 1), np.take_along_axis(dist, order, 1)
    width = int(np.isfinite(dist).sum(axis=1).max(initial=0))
    found, dist = found[:, :width], dist[:, :width].astype(np.float64)
    v = x[found].astype(np.float64)
    size = np.einsum("ijk,ijk->ij", v, v)
    between = size[:, :, None] + size[:, None, :] - 2 * (v @ v.transpose(0, 2, 1))
    between *= RELAXED * RELAXED
    alive, count = np.isfinite(dist), np.zeros(len(found), np.int64)
    out = np.full((len(found), degree), -1)
    for i in range(width):
        keep = np.flatnonzero(alive[:, i] & (count < degree))
        out[keep, count[keep]] = found[keep, i]
        count[keep] += 1
        alive[keep] &= between[keep, i, :] > dist[keep]
    return out


def _candidates(mine: np.ndarray, opened: list, b: int) -> tuple[np.ndarray, np.ndarray]:
    """What each row's search has opened, as padded arrays, without itself."""
    width = sum(n.shape[1] for _, n, _ in opened)
    found, dist, at = np.full((b, width), -1), np.full((b, width), np.inf), 0
    for rows, node, d in opened:
        found[rows, at:at + node.shape[1]] = node
        dist[rows, at:at + node.shape[1]] = np.where(node >= 0, d, np.inf)
        at += node.shape[1]
    dist[found == mine[:, None]] = np.inf
    return found, dist


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """``(edges, starts)`` of distinct directions: for each its neighbours, -1
    where there are fewer than ``degree``, and the entries that searches start from."""
    n = len(x)
    edges = np.full((n, degree), -1, np.int32)
    middle = int(np.argmin(((x - x.mean(axis=0)) ** 2).sum(axis=1)))
    order = np.random.default_rng(n).permutation(n)
    order = np.concatenate([[middle], order[order != middle]])
    done = 1
    while done < n:
        batch = order[done:done + min(done, BATCH)]
        _, _, opened = beam_search(x, edges, order[:min(done, entries(n))], x[batch], beam)
        found, dist = _candidates(batch, opened, len(batch))
        out = robust_prune(x, found, dist, degree)
        edges[batch] = out
        done += len(batch)
        # the way back: new neighbours of every target, nearest first where a list overflows
        row, col = np.nonzero(out >= 0)
        to, new = out[row, col], batch[row]
        by = np.argsort(to, kind="stable")
        to, new = to[by], new[by]
        target, first, many = np.unique(to, return_index=True, return_counts=True)
        both = np.full((len(target), degree + int(many.max(initial=0))), -1)
        both[:, :degree] = edges[target]
        both[np.repeat(np.arange(len(target)), many), degree + np.arange(len(to)) - np.repeat(first, many)] = new
        full = (both >= 0).sum(axis=1) > degree
        short = both[~full]
        edges[target[~full]] = np.take_along_axis(short, np.argsort(short < 0, axis=1, kind="stable"), 1)[:, :degree]
        if full.any():
            wide, at = both[full], np.flatnonzero(full)
            for i in range(0, len(at), BATCH):
                some = wide[i:i + BATCH]
                diff = x[some] - x[target[at[i:i + BATCH]]][:, None, :]
                d = np.where(some >= 0, np.einsum("ijk,ijk->ij", diff, diff), np.inf)
                order_ = np.argsort(d, axis=1, kind="stable")[:, :4 * degree]
                edges[target[at[i:i + BATCH]]] = robust_prune(x, np.take_along_axis(some, order_, 1), np.take_along_axis(d, order_, 1), degree)
    return edges, _starts(edges, order[:entries(n)])


def entries(n: int) -> int:
    """How many vectors of a graph of n searches start from."""
    return 1 + 4 * int(np.sqrt(n))


def _starts(edges: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``starts``, and one entry of each part that no path from them leads to."""
    reached, out, new = np.zeros(len(edges), bool), [], starts
    while True:
        out.append(new)
        reached[new] = True
        while len(new):
            new = np.unique(edges[new])
            new = new[new >= 0]
            new = new[~reached[new]]
            reached[new] = True
        new = np.flatnonzero(~reached)[:1]
        if not len(new):
            return np.concatenate(out)


def _vectors(rows: DataFrame, id_col: str, vec_col: str, more: list[Column]) -> DataFrame:
    x = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").alias("v"), *more)
    finite = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return x.where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).where(finite & F.exists("v", lambda e: e != 0))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def build_index(rows: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding", shard: int = SHARD) -> DataFrame:
    """One row ``dim, shard, vecs, ids, held, edges, starts`` for each shard.
    ``held``: how many of ``ids`` each vector has; results of up to k rows."""
    x = _vectors(rows, id_col, vec_col, []).dropDuplicates(["v", "id"])
    least = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    # bounded: the least k + 1 ids of equal vectors, picked before the shuffle
    entries = x.withColumn("r", least).where(F.col("r") <= k + 1).groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    entries = materialize(entries.withColumn("dim", F.size("v")), "ann-entries")
    parts = entries.groupBy("dim").agg(F.ceil(F.count("*") / shard).alias("parts"))
    dealt = entries.join(parts, "dim").withColumn("shard", F.pmod(F.xxhash64("v"), "parts")).select("dim", "shard", "v", "ids")
    # a shard is little data and long work, so each is a task of its own
    dealt = dealt.repartition(parts.agg(F.coalesce(F.sum("parts"), F.lit(1))).first()[0], "dim", "shard")
    wide = 8 if dict(entries.dtypes)["v"] == "array<double>" else 4

    def build(table: pa.Table) -> pa.Table:
        t = table.combine_chunks()
        dim = t.column("dim")[0].as_py()
        vecs = _matrix(t.column("v").combine_chunks(), dim).astype(f"f{wide}")
        ids = t.column("ids").combine_chunks()
        edges, starts = build_graph(directions(vecs))
        return pa.table({"dim": pa.array([dim], pa.int32()), "shard": t.column("shard")[:1].cast(pa.int64()), "vecs": pa.array([vecs.tobytes()], pa.binary()),
                         "ids": pa.array([ids.flatten().to_numpy().astype("<i8").tobytes()], pa.binary()),
                         "held": pa.array([ids.value_lengths().to_numpy().astype("<i4").tobytes()], pa.binary()),
                         "edges": pa.array([edges.astype("<i4").tobytes()], pa.binary()), "starts": pa.array([starts.astype("<i4").tobytes()], pa.binary())})

    return materialize(dealt.groupBy("dim", "shard").applyInArrow(build, _INDEX), "ann-index")


def search(index: DataFrame, rows: DataFrame, k: int, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", beam: int = SEARCH_BEAM) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest rows found for each query, ties to the smaller id."""
    asked = _vectors(rows, id_col, vec_col, [is_query.alias("q")]).where("q").drop("q").dropDuplicates(["v", "id"]).withColumn("dim", F.size("v"))
    asked = asked.withColumn("at", F.monotonically_increasing_id())
    wide = 8 if dict(asked.dtypes)["v"] == "array<double>" else 4

    def pack(batches):
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims).tolist():
                own = batch.filter(pa.array(dims == dim))
                for a in range(0, own.num_rows, BATCH):
                    part = own.slice(a, BATCH)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([dim], pa.int32()), pa.array([part.column(0).to_numpy().astype("<i8").tobytes()], pa.binary()),
                        pa.array([part.column(3).to_numpy().astype("<i8").tobytes()], pa.binary()),
                        pa.array([_matrix(part.column(1), dim).astype(f"f{wide}").tobytes()], pa.binary())], names=["dim", "qid", "at", "q"])

    packed = materialize(asked.select("id", "v", "dim", "at").mapInArrow(pack, "dim int, qid binary, at binary, q binary"), "ann-queries")
    met = packed.join(index.select("dim", "shard"), "dim").join(index, ["dim", "shard"]).select("dim", "qid", "at", "q", "vecs", "ids", "held", "edges", "starts")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                dim = batch.column(0)[i].as_py()
                qid, at, q, vecs, ids, held, edges, starts = (np.frombuffer(batch.column(j + 1)[i].as_buffer(), t) for j, t in enumerate(
                    ("<i8", "<i8", f"<f{wide}", f"<f{wide}", "<i8", "<i4", "<i4", "<i4")))
                q, vecs, edges = q.reshape(-1, dim), vecs.reshape(-1, dim), edges.reshape(len(held), -1)
                first = np.cumsum(held) - held
                found, dist, _ = beam_search(directions(vecs), edges, starts, directions(q), beam)
                out: list[list[np.ndarray]] = [[], [], [], []]
                for j in range(len(q)):
                    near = found[j][found[j] >= 0]
                    score = cosines(q[j], vecs[near])
                    own = np.repeat(np.arange(len(near)), held[near])
                    cand = ids[first[near][own] + np.arange(len(own)) - np.repeat(np.cumsum(held[near]) - held[near], held[near])]
                    score = score[own][cand != qid[j]]
                    cand = cand[cand != qid[j]]
                    best = np.lexsort((cand, -score))[:k]
                    for column, part in zip(out, (np.full(len(best), at[j]), np.full(len(best), qid[j]), cand[best], score[best])):
                        column.append(part)
                cols = [np.concatenate(c) for c in out]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["at", "query_id", "vec_id", "score"])

    best = met.mapInArrow(run, "at long, query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("at").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(rows: DataFrame, k: int, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``search`` in an index of all rows."""
    return search(build_index(rows, k, id_col, vec_col), rows, k, is_query, id_col, vec_col)
