"""Prefix trie of conversations by union-find over sorted-neighbour LCP edges.

A conversation is a sequence of turns (role, text); every distinct sequence of
first d turns is a node of depth d. In lexicographic order the members of a node
stand side by side, and neighbours are joined by an edge as deep as their common
prefix. Taking the edges from the deepest up, every merge of two components
makes (or extends) a branching node at the edge's depth.

Steps, each over all rows:

1. ``turn_tokens``: a 128-bit fingerprint and the code points of every turn.
2. ``sequences``: turns ordered by range partitions, packed into pieces; a
   conversation that spans partitions gets its offsets from one count a
   partition, so it is never gathered.
3. Pieces are cut at multiples of ``SEGMENT`` turns. A segment belongs to the
   trie below its own prefix's fingerprint, so rows stay short however long a
   conversation is, and the tries of all segments are one trie.
4. Segments are ordered (ids last, so equal conversations are dealt over many
   tasks) and each task takes blocks of them: union-find gives the block's
   forest. Nodes inside a block are final. Nodes that touch a block's end, and
   shared ones that go on in a deeper segment, are open: what hangs on them is
   contracted to counts and sums.
5. Open nodes of all blocks are merged by fingerprint, and sums go up between
   them by doubled jumps, in as many rounds as the depth has binary digits.

Fingerprints of prefixes are XORs of turn fingerprints salted by position, two
lanes of 64 bits. Turns stand by number, NULL first; equal numbers by
fingerprint. NULL roles and texts are empty ones. Rows without a conversation id
take no part. Repeated rows are turns of their own. Columns besides the four
named are not read. An empty table has no nodes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.runs import cut_runs, joined, pack_runs, slices
from tidemark.llm.textblocks import mix, ragged
from tidemark.session import materialize, scratch_path

SEGMENT = 256                    # turns of a conversation in one row
BLOCK = 1 << 17                  # turns (or conversations) of a block
CHUNK = 8192                     # ids in one row of an open node's ends
STEP = 1024                      # segments in one window when fingerprints are accumulated
_TURN = np.dtype([("a", "<i8"), ("b", "<i8"), ("chars", "<i4")])
WIDTH = _TURN.itemsize
NO_ENDS = hashlib.sha256(b"").hexdigest()
NODE = ["depth", "a", "b"]
_FOREST = ("kind int, depth long, a long, b long, pa long, pb long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
           "n_leaves long, saved_tokens long, chars long, ends_sha256 string, first_id long, ids binary")
DONE, WAITS, OPEN, ENDS = range(4)                   # kinds of rows that a block gives


def turn_tokens(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv, turn, a, b, chars`` of every turn."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    return conversations.select(F.col(f"`{id_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
                                F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), role, text).alias("b"),
                                F.length(text).alias("chars")).where("conv IS NOT NULL")


def sequences(tokens: DataFrame) -> DataFrame:
    """``conv, first, n, data``: pieces of up to ``SEGMENT`` turns in a row."""
    def record(batch):
        turns = np.empty(batch.num_rows, _TURN)
        for c in _TURN.names:
            turns[c] = batch.column(batch.schema.names.index(c)).to_numpy()
        return turns.view(np.uint8)

    return pack_runs(tokens, ["conv", "turn", "a", "b"], record, WIDTH, SEGMENT, "trie-turns")


def with_head_of(pieces: DataFrame, other: Column, turns: Column, most: int, among: Column) -> DataFrame:
    """Conversations whose first ``turns`` (at most ``most``) turns are replaced
    by those of conversation ``other``, one of ``among``; columns over ``conv``.
    Without such a conversation they just go."""
    heads = pieces.where(among & (F.col("first") < most)).groupBy(F.col("conv").alias("other")).agg(
        F.array_sort(F.collect_list(F.struct("first", F.substring("data", 1, most * WIDTH).alias("data")))).alias("h"))
    heads = heads.select("other", joined("h").alias("head"))
    x = pieces.withColumns({"other": other, "turns": turns.cast("long")}).join(heads, "other", "left")
    head = F.coalesce(F.expr(f"substring(head, 1, cast(turns AS int) * {WIDTH})"), F.lit(b""))
    x = x.withColumns({"head": head, "cut": F.greatest(F.lit(0), F.least("n", F.col("turns") - F.col("first")))})
    left = F.expr(f"substring(data, cast(cut AS int) * {WIDTH} + 1)")
    starts = F.col("first") == 0
    x = x.withColumn("data", F.when(starts, F.concat("head", left)).otherwise(left)).withColumn(
        "first", F.when(starts, F.lit(0)).otherwise(F.greatest("first", "turns") - F.col("turns") + F.octet_length("head") / WIDTH).cast("long"))
    x = x.withColumn("n", (F.octet_length("data") / WIDTH).cast("long"))
    return x.where("first = 0 OR n > 0").select("conv", "first", "n", "data")


def _segments(pieces: DataFrame, size: int) -> DataFrame:
    """``conv, seg, ra, rb, n, last, key, chars``: rows of up to ``size`` turns,
    the fingerprint of what stands before, salted fingerprints of the turns."""
    cut = cut_runs(pieces, ["conv"], size, WIDTH, "seg")

    def salt(batches):
        for batch in batches:
            seg = batch.column(1).to_numpy()
            data = [x or b"" for x in batch.column(2).to_pylist()]
            n = np.array([len(x) // WIDTH for x in data], np.int64)
            turns = np.frombuffer(b"".join(data), _TURN)
            place = ragged(seg * size, n).astype(np.uint64)
            lanes = np.empty((len(turns), 2), np.uint64)
            with np.errstate(over="ignore"):
                for i, c in enumerate("ab"):
                    lanes[:, i] = mix(turns[c].view(np.uint64) if turns[c].flags.c_contiguous else turns[c].astype(np.uint64)) ^ mix(place * np.uint64(2) + np.uint64(i + 1))
                    lanes[:, i] = mix(lanes[:, i] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(i))
            at = np.concatenate([[0], np.cumsum(n)])
            whole = np.zeros((len(n), 2), np.uint64)
            if len(turns):
                full = n > 0
                whole[full] = np.bitwise_xor.reduceat(lanes, at[:-1][full], axis=0)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(n), slices(lanes.astype(">u8").view(np.uint8).reshape(-1), at * 16),
                slices(turns["chars"].astype("<i4").view(np.uint8), at * 4), pa.array(whole[:, 0].astype(np.int64)), pa.array(whole[:, 1].astype(np.int64))],
                names=["conv", "seg", "n", "key", "chars", "xa", "xb"])

    segs = materialize(cut.mapInArrow(salt, "conv long, seg long, n long, key binary, chars binary, xa long, xb long"), "trie-segments")
    several = F.expr(f"seg > 0 OR n = {size}")                           # may be one of several segments
    long = segs.where(several).withColumn("step", F.expr(f"seg div {STEP}"))
    inside = Window.partitionBy("conv", "step").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy("conv").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    steps = long.groupBy("conv", "step").agg(F.bit_xor("xa").alias("sa"), F.bit_xor("xb").alias("sb")).select(
        "conv", "step", *(F.coalesce(F.bit_xor(c).over(ahead), F.lit(0)).alias(c) for c in ("sa", "sb")))
    more = segs.where("seg > 0").select("conv", (F.col("seg") - 1).alias("seg"), F.lit(False).alias("last"))
    before = {f"r{c}": F.coalesce(F.bit_xor(f"x{c}").over(inside), F.lit(0)) for c in "ab"}
    long = long.withColumns(before).join(steps, ["conv", "step"]).join(more, ["conv", "seg"], "left")
    cols = ["conv", "seg", "ra", "rb", "n", "last", "key", "chars"]
    long = long.withColumns({"ra": F.col("ra").bitwiseXOR(F.col("sa")), "rb": F.col("rb").bitwiseXOR(F.col("sb")), "last": F.coalesce("last", F.lit(True))})
    short = segs.where(~several).withColumns({"ra": F.lit(0).cast("long"), "rb": F.lit(0).cast("long"), "last": F.lit(True)})
    return short.select(*cols).unionByName(long.select(*cols))


def merge_by_depth(lens: np.ndarray, lcp: np.ndarray):
    """The branching nodes of a sorted block: union-find over its neighbour
    edges, deepest first. ``lcp[i]`` is the edge between rows i and i + 1, -1 for
    none. Returns depth, upper node (-1: none), first and last row of the nodes,
    and the node in which each row ends."""
    n = len(lens)
    root, right, top = list(range(n)), list(range(n)), list(range(n))    # a component's root is its first row
    depth, up, lo, hi, same = lens.tolist(), [-1] * n, list(range(n)), list(range(n)), list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    order = np.argsort(-lcp, kind="stable")
    for e, d in zip(order.tolist(), lcp[order].tolist()):
        if d < 0:
            break
        x, y = find(e), find(e + 1)
        a, b = top[x], top[y]
        lo[a], hi[a], lo[b], hi[b] = x, right[x], y, right[y]
        if depth[a] == d and depth[b] == d:              # one node, seen from both sides
            same[b] = a
        elif depth[a] == d:
            up[b] = a
        elif depth[b] == d:
            up[a], top[x] = b, b
        else:
            up[a] = up[b] = top[x] = len(depth)
            depth.append(d)
            up.append(-1)
            lo.append(x)
            hi.append(right[y])
            same.append(top[x])
        root[y], right[x] = x, right[y]
    for x in range(n):
        if root[x] == x:
            lo[top[x]], hi[top[x]] = x, right[x]
    same = np.array(same)
    while (same[same] != same).any():
        same = same[same]
    depth, up, lo, hi = np.array(depth), np.array(up), np.array(lo), np.array(hi)
    up = np.where(up >= 0, same[up], -1)
    alive = np.flatnonzero(same == np.arange(len(same)))
    new = np.full(len(same), -1)
    new[alive] = np.arange(len(alive))
    return depth[alive], np.where(up[alive] >= 0, new[up[alive]], -1), lo[alive], hi[alive], new[same[:n]]


def _block(tree: np.ndarray, segment: np.ndarray, roots: np.ndarray, key: list, conv: np.ndarray, lens: np.ndarray, last: np.ndarray, chars: list, size: int):
    """Rows ``_FOREST`` of one sorted block. ``tree``: a number for each (segment, root)."""
    n = len(conv)
    lanes = np.frombuffer(b"".join(key), ">u8").reshape(-1, 2)
    off = np.concatenate([[0], np.cumsum(lens)])
    many = np.concatenate([[0], np.cumsum(np.frombuffer(b"".join(chars), "<i4").astype(np.int64))])
    lcp = np.full(max(n - 1, 0), -1)
    if n > 1:
        common = np.minimum(lens[:-1], lens[1:])
        left, right = ragged(off[:-2], common), ragged(off[1:-1], common)
        place = ragged(np.zeros(n - 1, np.int64), common)
        reach = np.where((lanes[left] == lanes[right]).all(axis=1), size + 1, place)
        lcp, some = np.zeros(n - 1, np.int64), common > 0
        starts = np.cumsum(common) - common
        if some.any():
            lcp[some] = np.minimum(np.minimum.reduceat(reach, starts[some]), common[some])
        lcp[tree[1:] != tree[:-1]] = -1
    depth, up, lo, hi, ends_in = merge_by_depth(lens, lcp)

    bare = np.flatnonzero((up < 0) & (depth > 0))            # tries without a node for the root itself
    up[bare] = len(depth) + np.arange(len(bare))
    depth, up = np.append(depth, np.zeros(len(bare), np.int64)), np.append(up, np.full(len(bare), -1))
    lo, hi = np.append(lo, lo[bare]), np.append(hi, hi[bare])
    m = len(depth)
    above = np.where(up >= 0, depth[up], 0)
    count = hi - lo + 1
    least = np.full(m, np.iinfo(np.int64).max)
    np.minimum.at(least, ends_in, conv)
    through = np.zeros(m, np.int64)                          # members that go on in a deeper segment
    np.add.at(through, ends_in, (~last).astype(np.int64))
    here = through.copy()                                    # those of them for which this node is the cut
    open_ = (lo == 0) | (hi == n - 1)
    children, leaves, saved = np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros(m, np.int64)
    for d in np.unique(depth)[::-1]:
        at = np.flatnonzero(depth == d)
        open_[at] |= (through[at] > 0) & (count[at] > 1)
        closed = at[~open_[at]]
        leaves[closed] += ((children[closed] == 0) & (here[closed] == 0)).astype(np.int64) + (here[closed] > 0)
        at = at[up[at] >= 0]
        np.minimum.at(least, up[at], least[at])
        np.add.at(through, up[at], through[at])
        closed = at[~open_[at]]
        np.add.at(children, up[closed], 1)
        np.add.at(leaves, up[closed], leaves[closed])
        np.add.at(saved, up[closed], saved[closed] + (count[closed] - 1) * (many[off[lo[closed]] + d] - many[off[lo[closed]] + above[closed]]))

    # every depth from below the upper node to the node's own; a root stands for itself
    is_root = up < 0
    node = np.repeat(np.arange(m), np.where(is_root, 1, depth - above))
    d = np.where(is_root[node], 0, ragged(above + 1, np.where(is_root, 1, depth - above)))
    own, row, top = d == depth[node], lo[node], d == above[node] + 1
    acc = np.bitwise_xor.accumulate(np.concatenate([np.zeros((1, 2), np.uint64), lanes.astype(np.uint64)]), axis=0)

    def print_of(row, d):
        return (roots[row] ^ acc[off[row] + d] ^ acc[off[row]]).astype(np.int64)

    base = segment[row] * size
    mark, parent = print_of(row, d), print_of(row, np.maximum(d - 1, 0))
    cut = own & (here[node] > 0)                             # goes on below
    n_children = np.where(own, children[node] + np.where(open_[node], 0, cut), np.where(open_[node], 0, 1))
    code = np.where(is_root[node], 0, many[off[row] + d] - many[off[row] + np.maximum(d - 1, 0)])
    sums = np.where(own, saved[node], np.where(open_[node], 0, saved[node]))
    sums = sums + np.where(open_[node], 0, (count[node] - 1) * (many[off[row] + depth[node]] - many[off[row] + np.maximum(d - 1, 0)]))
    n_leaves = np.where(own | ~open_[node], leaves[node], 0)
    upper = np.where(top, up[node], node)
    lower_half = is_root[node] & (segment[row] > 0)          # the other half of a node at a cut
    # members of a root may also end at the cut above it, so below a root the parent is known after the merge;
    # if a cut's node was final in the trie above, its lower half just tells this parent and is no row of the result
    kind = np.where(open_[node] | is_root[node], OPEN, np.where(open_[upper] | is_root[upper], WAITS, DONE))
    hashes = np.full(m, NO_ENDS, object)
    finish = np.flatnonzero(last)
    at = ends_in[finish]
    edges = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else np.zeros(0, np.int64)
    # rows that end in one node stand together but for those that go on; both come in ascending order of ids
    ids: dict[int, list] = {}
    for x, y in zip(edges.tolist(), np.append(edges[1:], len(at)).tolist()):
        ids.setdefault(int(at[x]), []).append(conv[finish[x:y]])
    chunks = []
    for k, parts in ids.items():
        mine = np.concatenate(parts)
        if open_[k] or is_root[k]:
            chunks += [(k, mine[i:i + CHUNK]) for i in range(0, len(mine), CHUNK)]
        else:
            hashes[k] = hashlib.sha256(",".join(map(str, mine.tolist())).encode()).hexdigest()
    closed_ends = np.where(own, hashes[node], NO_ENDS)
    is_open = kind == OPEN
    hide = is_open | (kind == WAITS)
    no_parent = d == 0
    yield pa.RecordBatch.from_arrays([
        pa.array(kind.astype(np.int32)), pa.array(base + d), pa.array(mark[:, 0]), pa.array(mark[:, 1]),
        pa.array(parent[:, 0], mask=no_parent), pa.array(parent[:, 1], mask=no_parent), pa.array(least[node]),
        pa.array(least[upper], mask=hide), pa.array(np.where(lower_half, 0, count[node])), pa.array(n_children), pa.array(n_leaves), pa.array(sums), pa.array(code),
        pa.array(closed_ends.tolist(), pa.string(), mask=is_open), pa.nulls(len(node), pa.int64()), pa.nulls(len(node), pa.binary())],
        names=[c.split()[0] for c in _FOREST.split(", ")])
    if chunks:
        k = np.array([k for k, _ in chunks])
        mark, none = print_of(lo[k], depth[k]), pa.nulls(len(k), pa.int64())
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(k), ENDS, np.int32)), pa.array(segment[lo[k]] * size + depth[k]), pa.array(mark[:, 0]), pa.array(mark[:, 1]),
            *[none] * 9, pa.nulls(len(k), pa.string()), pa.array([int(c[0]) for _, c in chunks], pa.int64()),
            pa.array([c.astype("<i8").tobytes() for _, c in chunks], pa.binary())], names=[c.split()[0] for c in _FOREST.split(", ")])


def _forest(segments: DataFrame, size: int, block: int) -> DataFrame:
    order = ["seg", "ra", "rb", "key", "conv"]
    dealt = segments.repartitionByRange(*order).sortWithinPartitions(*order).select(*order, "n", "last", "chars")

    def blocks(batches):
        held, weight = [], 0

        def out():
            t = pa.Table.from_batches(held)
            seg, ra, rb, conv, n = (t.column(c).to_numpy() for c in ("seg", "ra", "rb", "conv", "n"))
            new = np.concatenate([[False], (seg[1:] != seg[:-1]) | (ra[1:] != ra[:-1]) | (rb[1:] != rb[:-1])])
            roots = np.stack([ra.astype(np.uint64), rb.astype(np.uint64)], axis=1)
            return _block(np.cumsum(new), seg, roots, t.column("key").to_pylist(), conv, n, t.column("last").to_numpy(), t.column("chars").to_pylist(), size)

        for batch in batches:
            # as many rows as fill the block; a row has at most ``size`` turns
            while batch.num_rows:
                total = np.cumsum(np.maximum(batch.column(5).to_numpy(), 1))
                take = max(1, int(np.searchsorted(total, block - weight, side="right"))) if weight < block else 0
                if take:
                    held.append(batch.slice(0, take))
                    weight += int(total[min(take, len(total)) - 1])
                    batch = batch.slice(take)
                if weight >= block or batch.num_rows:
                    yield from out()
                    held, weight = [], 0
        if held:
            yield from out()

    path = scratch_path(segments.sparkSession, "trie-forest")
    dealt.mapInArrow(blocks, _FOREST).write.partitionBy("kind").parquet(path)
    return segments.sparkSession.read.schema(_FOREST).option("basePath", path).parquet(path)


def _ends(chunks: DataFrame) -> DataFrame:
    """``NODE`` and the hash of the ids that end there: a node's chunks pass one
    hash in ascending order as a stream, never held together."""
    dealt = chunks.select(*NODE, "first_id", "ids").repartition(*NODE).sortWithinPartitions(*NODE, "first_id")

    def run(batches):
        now, h = None, None

        def row():
            return pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in now), pa.array([h.hexdigest()])], names=[*NODE, "ends"])

        for batch in batches:
            for i in range(batch.num_rows):
                node = tuple(batch.column(j)[i].as_py() for j in range(3))
                ids = ",".join(map(str, np.frombuffer(batch.column(4)[i].as_py(), "<i8").tolist())).encode()
                if node == now:
                    h.update(b",")
                else:
                    if now is not None:
                        yield row()
                    now, h = node, hashlib.sha256()
                h.update(ids)
        if now is not None:
            yield row()

    return dealt.mapInArrow(run, "depth long, a long, b long, ends string")


def _totals(nodes: DataFrame) -> DataFrame:
    """Sums of ``leaves`` and ``saved`` over the open nodes below each one. In
    round r every node gives its sum to the one 2**r above it."""
    cur = materialize(nodes.select(*NODE, "leaves", "saved", F.when(F.col("pa").isNotNull(), F.col("depth") - 1).alias("jd"), F.col("pa").alias("ja"), F.col("pb").alias("jb")),
                      "trie-totals")
    jump = ["jd", "ja", "jb"]
    while not cur.where("jd IS NOT NULL").isEmpty():
        given = cur.where("jd IS NOT NULL").groupBy(*(F.col(j).alias(k) for j, k in zip(jump, NODE))).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        ahead = cur.select(*(F.col(k).alias(j) for j, k in zip(jump, NODE)), *(F.col(j).alias(f"n{j}") for j in jump))
        cur = materialize(cur.join(given, NODE, "left").join(ahead, jump, "left").select(
            *NODE, (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"),
            *(F.col(f"n{j}").alias(j) for j in jump)), "trie-totals")
    return cur.select(*NODE, F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))


def trie(pieces: DataFrame, size: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """The nodes of ``conv, first, n, data``: ``conv_id`` (smallest member),
    ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` (code points that members need not repeat, over the
    subtree), ``ends_sha256`` (of the ids that end in the node)."""
    rows = _forest(_segments(pieces, size), size, block)
    result = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    merged = materialize(rows.where(F.col("kind") == OPEN).groupBy(*NODE).agg(
        F.max("pa").alias("pa"), F.max("pb").alias("pb"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("closed"),
        F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"), F.max("chars").alias("chars")), "trie-open")
    kids = merged.where("pa IS NOT NULL").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("kids"))
    nodes = merged.join(kids, NODE, "left").withColumn("n_children", F.col("closed") + F.coalesce("kids", F.lit(0)))
    nodes = materialize(nodes.withColumns({
        "leaves": F.col("leaves") + (F.col("n_children") == 0).cast("long"),
        "saved": F.col("saved") + F.greatest(F.col("n_convs") - 1, F.lit(0)) * F.col("chars")}), "trie-open-nodes")
    # a parent may have very many children: written sides, so that the planner can split it
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    of_open = nodes.where("n_convs > 0").drop("leaves", "saved").join(_totals(nodes), NODE).join(_ends(rows.where(F.col("kind") == ENDS)), NODE, "left") \
        .join(parents, ["depth", "pa", "pb"], "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(NO_ENDS)))
    waiting = rows.where(F.col("kind") == WAITS).drop("parent_conv_id").join(parents, ["depth", "pa", "pb"])
    return rows.where(F.col("kind") == DONE).select(*result).unionByName(waiting.select(*result)).unionByName(of_open.select(*result))


def prefix_trie(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The prefix trie of a table of turns, see ``trie``. The d-th turn of
    conversation ``conv_id`` is the last one of the node's sequence."""
    return trie(sequences(turn_tokens(conversations, id_col, turn_col, role_col, text_col)))
