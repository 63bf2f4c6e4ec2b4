"""The prefix trie against a brute-force trie."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from conftest import SF_SMALL
from tidemark.llm import prefix_trie as PT
from tidemark.llm import queries as Q

TURN = "conv_id long, turn long, role string, text string, seg long, kind string, n_convs string"


def brute(convs):
    """``{conv: [(role, text), ...]}`` to the rows of the result."""
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        leaves[p] = sum(leaves[k] for k in kids.get(p, [])) or 1
        saved[p] = own + sum(saved[k] for k in kids.get(p, []))
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(kids.get(p, [])), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()) for p, m in members.items())


def ours(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                  for r in df.collect())


def random_convs(seed, n, most, hot=True):
    rng = random.Random(seed)
    convs = {}
    for c in rng.sample(range(-5, 5000), n):
        size = rng.choice([0, 1, 2, 3, most])
        convs[c] = [("ua"[i % 2], rng.choice(["", "é", "xyz", "four", "w" * 9][: rng.choice([1, 5])])) for i in range(size)]
        if hot and rng.random() < .3:
            convs[c] = [("u", "hot"), ("a", "answer"), ("u", "again")]
        if rng.random() < .2:
            other = rng.choice(list(convs))
            convs[c] = convs[other][: rng.randrange(most)] + [("u", str(c))] * rng.randrange(3)
    return convs


@pytest.mark.parametrize("seed,n,most,size,block", [(1, 60, 9, 256, 1 << 17), (2, 200, 12, 2, 7), (3, 200, 12, 3, 40), (4, 150, 30, 4, 1000), (5, 80, 40, 1, 11)])
def test_trie_equals_brute_force(spark, seed, n, most, size, block):
    convs = random_convs(seed, n, most)
    convs = {c: t for c, t in convs.items() if t}
    rows = [(c, i, r, t, 0, None, None) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    random.Random(seed).shuffle(rows)
    turns = spark.createDataFrame(rows, TURN).repartition(5)
    assert ours(PT.trie(PT.sequences(PT.turn_tokens(turns)), size, block)) == brute(convs)


def test_union_find_merges_deepest_edges_first():
    # rows: a, ab, abc, abd, b
    depth, up, lo, hi, at = PT.merge_by_depth(np.array([1, 2, 3, 3, 1]), np.array([1, 2, 2, 0]))
    spans = {(int(d), int(x), int(y)) for d, x, y in zip(depth, lo, hi)}
    assert spans == {(1, 0, 3), (2, 1, 3), (3, 2, 2), (3, 3, 3), (1, 4, 4), (0, 0, 4)}
    assert depth[at].tolist() == [1, 2, 3, 3, 1]
    assert up[at[2]] == at[1] and up[at[1]] == at[0] and depth[up[at[0]]] == 0


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(x, key=lambda y: y[0])] for c, x in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def test_query_equals_brute_force(spark):
    rows = [tuple(r)[:4] for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert ours(Q.op11_prefix_trie(spark, SF_SMALL)) == brute(rebuilt(rows))


def test_query_on_odd_rows(spark, tmp_path):
    rng = random.Random(5)
    rows = [(None, 1, "u", "x"), (None, None, None, None)]
    for c in [*range(0, 30), *range(201, 240), 100, 300]:
        for i in range(rng.randrange(1, 9)):
            rows.append((c, None if i == 0 and c % 3 == 0 else i, None if c % 4 == 0 else "u", rng.choice([None, "", "a", "long " * 4000])))
    rows += [(500, i, "u", "b") for i in range(700)] + [(507, i, "u", "b") for i in range(650)] + [r for r in rows if r[0] in (3, 200, 210)]
    path = str(tmp_path)
    spark.createDataFrame([r + (1, "k", "c") for r in rows], TURN).write.parquet(f"{path}/conversations.parquet")
    assert ours(Q.op11_prefix_trie(spark, path)) == brute(rebuilt(rows))


def test_empty_table(spark):
    assert PT.prefix_trie(spark.createDataFrame([], TURN)).collect() == []
