"""Connected components of an edge table by alternating large and small stars.

Every round rewrites the edges towards smaller neighbours; the rounds end when
an edge set maps to itself, which is then one star per component around its
smallest node. Edges stay in Spark; each round is written to the shared folder,
so the lineage is cut and a lost executor repeats at most one round. A node
with very many neighbours is handled by partial minima and by joins that the
adaptive planner can split.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.textblocks import mix
from tidemark.session import materialize

MAX_ROUNDS = 60


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_000_007).alias("s")).first()
    return r["n"], r["s"]


def components(edges: DataFrame) -> DataFrame:
    """``edges``: two long columns. Result: ``node, root``, one row for every
    node that is not its component's smallest; ``root`` is that smallest node.
    Self-loops, NULL ends and repeated edges do not matter."""
    a, b = edges.columns
    stars = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull()).where("u <> v").distinct()
    stars = materialize(stars, "components")
    before = _mark(stars)
    if not before[0]:
        return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
    for _ in range(MAX_ROUNDS):
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that the join below has plain shuffles on both sides and the planner can split a hot node
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "components-least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        last = stars
        stars = materialize(small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(
            least.select("u", F.col("m").alias("v"))).distinct(), "components")
        after = _mark(stars)
        # equal marks may be chance, so the edges themselves are compared then
        if after == before and stars.join(last, ["u", "v"], "left_anti").isEmpty():
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = after
    raise RuntimeError("components did not settle")


FIRST = 8                        # signatures of a node by which a pair is emitted once
DEALT_FIRST = 32                 # the same among partition signatures, of which close sets share very many
CROWD = 32                       # holders from which a signature's nodes are dealt anew
EMPTY = 3                        # empty groups that a partition allows for
SKETCH = ["p0", "p1", "p2", "p3"]                   # a set's parity sketch, 64 bits each
# the sketch of sets that are dealt anew: a short one of sets of some hundred elements still lets pairs pass
# that differ twice as much as linked ones, which are all pairs of a family of near copies that do not link
WIDE = [f"q{i}" for i in range(16)]


def apart(n: int, m: int, percent: int) -> int:
    """The most elements that are in just one of two linked sets of n and m."""
    return (100 - percent) * (n + m) // (100 + percent)


def size_classes(n: int, percent: int) -> list[tuple[int, int]]:
    """``(class, upper size)`` of the larger set in any link of an n-set."""
    out, low = [], 1
    while low <= 100 * n // percent:
        high = max(low, 100 * low // percent)                   # sizes low..high are one class
        if high >= n:
            out.append((low, high))
        low = high + 1
    return out


def partition_signatures(tokens: np.ndarray, percent: int) -> np.ndarray:
    """Signatures of which linked sets share at least one.

    A set is dealt into one group more than linked sets have elements apart,
    so one group at least is equal in both; its content is the signature.
    ``EMPTY`` more groups make up for groups that are empty in both; a set with
    more empty groups than that is indexed by these as well."""
    out = []
    for low, high in size_classes(len(tokens), percent):
        groups = apart(high, high, percent) + 1 + EMPTY
        group = (mix(tokens ^ np.uint64(0x94D049BB133111EB)) % np.uint64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        group, mine = group[order], mix(tokens[order])
        first = np.flatnonzero(np.diff(group, prepend=-1))
        with np.errstate(over="ignore"):
            content = np.add.reduceat(mine, first)
            label = mix(group[first].astype(np.uint64) + np.uint64(low << 24))
            out.append(mix(content + label))
            if groups - len(first) > EMPTY:
                empty = np.setdiff1d(np.arange(groups), group[first]).astype(np.uint64)
                out.append(mix(mix(empty + np.uint64(low << 24)) + np.uint64(1)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def parity_bits(tokens: np.ndarray, longs: int = len(SKETCH)) -> np.ndarray:
    """The parity sketch of a set of 64-bit hashes: a bit is set if an odd
    number of elements falls on it."""
    bits = 64 * longs
    at = (mix(tokens ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(bits)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little").view(np.int64)


RESIGNED = "sig long, node long, n long, root long, " + ", ".join(f"{c} long" for c in WIDE)


def resigned(node: int, root: int, tokens: np.ndarray, percent: int) -> pa.RecordBatch:
    """The rows of one node for ``RESIGNED``."""
    sig = np.unique(partition_signatures(tokens, percent).view(np.int64))
    same = [pa.array(np.full(len(sig), x, np.int64)) for x in (node, len(tokens), root, *parity_bits(tokens, len(WIDE)))]
    return pa.RecordBatch.from_arrays([pa.array(sig), *same], names=["sig", "node", "n", "root", *WIDE])


def close_links(held: DataFrame, sketches: DataFrame, percent: int, verify: Callable[[DataFrame], DataFrame],
                resign: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Components of all links among nodes that share a signature, without
    checking every pair of a large group. Nodes are sets that link when 100
    times their common elements are at least ``percent`` times all of them.

    ``held``: ``sig, node, n, leader``, a row for each holder of a shared
    signature with one leader per signature (or per part of its holders, with
    rows that tie the leaders); n is the set's size. ``sketches``: ``node`` and
    ``SKETCH``. ``verify``: pairs ``a, b`` to the pairs that link. ``resign``:
    ``node, root`` to rows ``RESIGNED``.

    1. Each node is checked against the leader that it shares most signatures
       with, which gives first components.
    2. Signatures whose holders are in different components are left. Pairs of
       holders of one that has less than ``CROWD`` are candidates. The holders
       of the others are dealt anew by ``partition_signatures``, of which
       linked sets always share one and others seldom do, and pairs that share
       one of those are candidates.
    3. Candidates in different components whose parity sketches differ in no
       more bits than linked sets differ in elements are all checked. Pairs
       inside a component cannot change it.

    Result as of ``components``."""
    near = f"100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)"
    second = held.select(F.col("node").alias("leader"), "n").distinct()
    votes = held.where("leader <> node").groupBy("node", "n", "leader").agg(F.count("*").alias("shared"))
    first = votes.alias("a").join(second.alias("b"), F.expr(f"a.leader = b.leader AND {near}")).groupBy("a.node").agg(
        F.max_by("a.leader", F.struct("a.shared", "a.leader")).alias("leader"))
    first = materialize(first.select(F.col("leader").alias("a"), F.col("node").alias("b")), "links-first")
    roots = components(materialize(verify(first), "links-edges"))
    placed = held.select("sig", "node", "n").distinct().join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = materialize(placed.join(sketches, "node"), "links-placed")
    mixed = placed.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("m")).where("lo < hi")
    mixed = materialize(mixed.select("sig", (F.col("m") >= CROWD).alias("crowd")), "links-mixed")
    open_ = placed.join(mixed, "sig")

    def pairs(rows: DataFrame, sketch: list[str], most: int) -> DataFrame:
        differ = " + ".join(f"bit_count(a.{c} ^ b.{c})" for c in sketch)
        apart_enough = f"a.root <> b.root AND {near} AND ({100 + percent}) * ({differ}) <= {100 - percent} * (a.n + b.n)"
        # only the least signature that two nodes share gives their pair, of the first ones of each
        least = rows.groupBy("node").agg(F.slice(F.array_sort(F.collect_set("sig")), 1, most).alias("least_sigs"))
        rows = rows.join(least, "node")
        once = "coalesce(array_min(array_intersect(a.least_sigs, b.least_sigs)), a.sig) >= a.sig"
        met = rows.alias("a").join(rows.alias("b"), F.expr(f"a.sig = b.sig AND a.node < b.node AND {apart_enough} AND {once}"))
        return met.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))

    few = pairs(open_.where("NOT crowd").drop("crowd"), SKETCH, FIRST)
    dealt = materialize(resign(open_.where("crowd").select("node", "root").distinct()), "links-resigned")
    mixed = dealt.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("sig")
    many = pairs(dealt.join(mixed, "sig"), WIDE, DEALT_FIRST)
    rest = materialize(few.unionByName(many).distinct(), "links-rest")
    more = materialize(verify(rest), "links-more")
    if more.isEmpty():
        return roots
    return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
