"""Graph search against exact search."""

import math
import random

import numpy as np
import pytest

from conftest import SF_SMALL
from tidemark.llm import ann_graph as AG
from tidemark.llm import queries as Q
from pyspark.sql import functions as F

VEC = "vec_id long, embedding array<float>, dim string, shard string, v int, rank int"


def cosine(a, b):
    a, b = np.array(a, float), np.array(b, float)
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return float((a * b).sum() / math.sqrt((a * a).sum() * (b * b).sum()))


def usable(rows):
    out = []
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            v = tuple(np.float32(x) for x in v)
            if (i, v) not in out:
                out.append((i, v))
    return out


def exact(rows, k, every):
    """``{(query id, vector): [(score, id), ...]}`` of the k nearest."""
    rows = usable(rows)
    return {(i, v): sorted(((-round(cosine(v, w), 9), j) for j, w in rows if j != i and len(w) == len(v)))[:k] for i, v in rows if i % every == 0}


def recall(df, want, k):
    """Share of the exact results found; checks ranks, order and scores."""
    got = {}
    for r in df.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hit = total = 0
    assert set(got) == {i for (i, _), w in want.items() if w}
    for (i, v), near in want.items():
        mine = sorted(got.get(i, []))
        assert [r for r, _, _ in mine] == list(range(1, len(near) + 1))
        assert [(-round(s, 9), j) for _, j, s in mine] == sorted((-round(s, 9), j) for _, j, s in mine)
        least = near[-1][0] if near else 0
        hit += sum(-round(s, 9) <= least for _, _, s in mine)
        total += len(near)
    return hit / total if total else 1.0


def test_recall_of_the_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert recall(Q.op13_ann_graph(spark, SF_SMALL), exact(rows, 5, 50), 5) >= 0.97


def test_scores_are_cosines_of_the_rows_named(spark):
    rows = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()}
    for r in Q.op13_ann_graph(spark, SF_SMALL).collect():
        assert r.query_id % 50 == 0 and r.vec_id != r.query_id and abs(r.score - cosine(rows[r.query_id], rows[r.vec_id])) < 1e-12


def test_odd_rows_ties_and_copies(spark):
    rng = random.Random(2)
    one = [rng.gauss(0, 1) for _ in range(6)]
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(150)] + [(i, one) for i in range(150, 400)]
    rows += [(500, None), (501, []), (502, [0.0] * 6), (503, [None, 1.0]), (504, [math.nan, 1.0]), (505, [math.inf, 1.0]), (None, one), (550, [3.0, 4.0]), (600, [1e38, 1e38]),
             (650, [1e-44, 0.0]), (700, [1.0, 1.0, 1.0]), (200, one), (200, one), (750, [2 * x for x in one]), (750, [-x for x in one])]
    df = spark.createDataFrame([r + ("d", "s", 1, 1) for r in rows], VEC).repartition(3)
    got = {}
    for r in AG.nearest(df, 5, F.col("vec_id") % 50 == 0).collect():
        got.setdefault((r.query_id, r["rank"]), []).append((round(r.score, 9), r.vec_id))
    for (i, v), near in exact(rows, 5, 50).items():
        mine = [got[i, k + 1] for k in range(len(near))]
        assert all((-s, j) in m for (s, j), m in zip(near, mine)), (i, near, mine)
    assert not any(q == 700 for q, _ in got)


def test_near_copies_do_not_hide_the_others(spark):
    rng = np.random.default_rng(3)
    far = rng.normal(size=(1500, 24))
    near = rng.normal(size=24) + rng.normal(size=(1500, 24)) * 0.02
    rows = [(i, v.tolist()) for i, v in enumerate(rng.permutation(np.concatenate([far, near])))]
    df = spark.createDataFrame([r + ("d", "s", 1, 1) for r in rows], VEC)
    x = np.array([v for _, v in rows], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    got, hit, total = {}, 0, 0
    for r in AG.search(AG.build_index(df, 5, shard=800), df, 5, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    for q in range(0, 3000, 20):
        s = x @ x[q]
        s[q] = -2
        hit, total = hit + len(got[q] & set(np.argsort(-s)[:5].tolist())), total + 5
    assert hit / total >= 0.95


def test_every_vector_is_reached_and_edges_are_pruned():
    rng = np.random.default_rng(1)
    x = AG.directions(np.concatenate([rng.normal(size=(400, 8)), rng.normal(size=8) + rng.normal(size=(400, 8)) * 1e-3]))
    edges, starts = AG.build_graph(x, degree=12, beam=20)
    reached, new = set(), set(starts.tolist())
    while new:
        reached |= new
        new = {int(e) for i in new for e in edges[i] if e >= 0} - reached
    assert len(reached) == 800
    assert not (edges == np.arange(800)[:, None]).any()
    # of candidates in one direction the nearest stays, of others all
    line = np.array([[0, 0], [1, 0], [2, 0], [3, 0], [0, 1], [0, -1.5]], np.float32)
    cand, d = np.array([[3, 1, 4, 2, 5, -1]]), np.array([[9, 1, 1, 4, 2.25, np.inf]])
    assert set(AG.robust_prune(line, cand, d, 4)[0].tolist()) == {1, 4, 5, -1}


@pytest.mark.parametrize("n", [1, 2, 5])
def test_small_and_empty_tables(spark, n):
    rows = [(50 * i, [float(i + 1), 1.0]) for i in range(n)]
    df = spark.createDataFrame([r + ("d", "s", 1, 1) for r in rows], VEC)
    assert AG.nearest(df, 5, F.col("vec_id") % 50 == 0).count() == n * min(n - 1, 5)
    assert AG.nearest(df, 5, F.col("vec_id") < 0).count() == 0
    assert AG.nearest(df.limit(0), 5, F.col("vec_id") % 50 == 0).count() == 0
