"""Jaccard self-join of documents on word shingles by token-combination prefixes.

A document's tokens are its distinct hashed word shingles. Two documents link
when ``100 * common >= percent * union``; then at most ``slack(n)`` of the n
tokens of either miss in the other. All tokens get one global order: by class
(how many documents hold them), by group inside a class, by hash. Tokens of
class 1 (rare) are indexed alone, those of class k (frequent) as combinations
of k tokens of one group. A document's prefix is extended until it holds
``sum(max(0, tokens of the group - k + 1)) > slack(n)``: linked documents then
share an indexed combination, for otherwise too many tokens of the shorter
prefix would miss. The number of groups follows the larger document's size
class, so a document may index its combinations for two size classes.

Steps, each a Spark job over all rows:

1. ``doc_id, n, node`` of every document (node: fingerprint of the set, so equal
   sets are one node) and, in the same scan, the documents per token cell (the
   hash's upper 32 bits) as packed arrays dealt by cell range.
2. Signatures of distinct sets, dealt by signature range; a task sends a
   signature once, so a very common one is never gathered in one task.
3. One candidate per node: the leader it shares most signatures with. Exact
   check on the texts, then components.
4. Nodes that share a signature but are still in different components, and are
   not ruled out by size or parity, are checked too, and the components are
   completed (see ``components.close_links``, also for crowded signatures).

Token cells over the class threshold are broadcast; the threshold is the least
power of two for which at most ``MOST_FREQUENT`` cells pass, so the broadcast is
bounded at every size. NULL and empty texts have no tokens and no links;
documents without an id have no component; repeated rows are equal sets.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import RESIGNED, SKETCH, close_links, parity_bits, resigned
from tidemark.llm.textblocks import blocks, lean, lower_ascii, mix, span_hashes, words
from tidemark.session import materialize

MOST_FREQUENT = 2_000_000        # bound of the broadcast: cells of frequent tokens
LEAST_FREQUENT = 8               # a token in fewer documents is always rare
THIRD_CLASS = 32                 # times the threshold from which combinations take three tokens
_RANGE_BITS = 12


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int):
    """Yield ``(row, sorted distinct 64-bit shingle hashes)`` for rows with words."""
    data = lower_ascii()[data]
    starts, ends, row = words(data, offsets, "space")
    if not len(starts):
        return
    h = span_hashes(data, starts, ends)
    with np.errstate(over="ignore"):
        many = max(len(h) - size + 1, 0)
        whole = np.zeros(many, np.uint64)
        for i in range(size):
            whole = whole * np.uint64(0xD6E8FEB86659FD93) + h[i:i + many]
        whole = mix(whole + np.uint64(size))
        edge = np.searchsorted(row, np.arange(len(offsets)))
        for r in np.flatnonzero(np.diff(edge)).tolist():
            a, b = edge[r], edge[r + 1]
            if b - a >= size:
                s = np.sort(whole[a:b - size + 1])
                yield r, s[np.concatenate([[True], s[1:] != s[:-1]])]
            else:                                  # fewer words: the whole sequence is the one shingle
                one = np.zeros(1, np.uint64)
                for x in h[a:b]:
                    one = one * np.uint64(0xD6E8FEB86659FD93) + x
                yield r, mix(one + np.uint64(int(b - a)))


def fingerprint(tokens: np.ndarray) -> int:
    """A signed 64-bit fingerprint of a token set."""
    with np.errstate(over="ignore"):
        total = mix(tokens ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64)
        return int(mix(np.array([total + np.uint64(len(tokens))]))[0].astype(np.int64))


def slack(n: int, percent: int) -> int:
    """The most tokens of an n-token set that a linked set may lack."""
    return n - -(-percent * n // 100)


def _planes(x: np.ndarray) -> bytes:
    """Integers byte plane by byte plane: upper planes of small numbers compress away."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _unplane(raw: bytes, kind) -> np.ndarray:
    item = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(item, -1).T).reshape(-1).view(kind)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))


def _count_pass(docs: DataFrame, size: int) -> DataFrame:
    """``kind, key, n, node, text_hash``: documents (kind 0: id, tokens, node) and token
    cells that at least ``LEAST_FREQUENT`` documents hold (kind 1: cell, documents)."""
    def scan(batches):
        seen, cells = set(), []
        for batch in batches:
            ids, n, node = batch.column(0).to_pylist(), [0] * batch.num_rows, [None] * batch.num_rows
            for first, data, offsets in blocks(batch.column(1)) if batch.num_rows else ():
                for r, s in shingle_sets(data, offsets, size):
                    n[first + r], node[first + r] = len(s), fingerprint(s)
                    if node[first + r] not in seen:
                        seen.add(node[first + r])
                        cells.append((s >> np.uint64(32)).astype(np.uint32))
            yield pa.RecordBatch.from_pydict({
                "r": pa.array([hash(i) & 4095 for i in ids], pa.int32()), "kind": pa.array([0] * len(ids), pa.int32()),
                "key": pa.array(ids, pa.int64()), "n": pa.array(n, pa.int64()), "node": pa.array(node, pa.int64()),
                "text_hash": batch.column(2), "cells": pa.array([None] * len(ids), pa.binary()), "counts": pa.array([None] * len(ids), pa.binary())})
        if cells:
            cell, count = np.unique(np.concatenate(cells), return_counts=True)
            cut = np.searchsorted(cell, np.arange(1, 1 << _RANGE_BITS, dtype=np.uint64) << np.uint64(32 - _RANGE_BITS))
            out = {k: [] for k in ("r", "kind", "key", "n", "node", "text_hash", "cells", "counts")}
            for r, (a, b) in enumerate(zip(np.append(0, cut), np.append(cut, len(cell)))):
                if a < b:
                    out["r"].append(r)
                    out["kind"].append(1)
                    out["cells"].append(_planes(np.diff(cell[a:b], prepend=np.uint32(0))))
                    out["counts"].append(_planes(count[a:b].astype(np.uint32)))
                    for k in ("key", "n", "node", "text_hash"):
                        out[k].append(None)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("r", pa.int32()), ("kind", pa.int32()), ("key", pa.int64()), ("n", pa.int64()), ("node", pa.int64()),
                ("text_hash", pa.int64()), ("cells", pa.binary()), ("counts", pa.binary())]))

    def gather(batches):
        cells, counts = [], []
        for batch in batches:
            kind = batch.column(0).to_numpy()
            docs_only = batch.filter(pa.array(kind == 0)).select([0, 1, 2, 3, 4])
            if docs_only.num_rows:
                yield docs_only
            for i in np.flatnonzero(kind == 1).tolist():
                cells.append(np.cumsum(_unplane(batch.column(5)[i].as_py(), np.uint32), dtype=np.uint32))
                counts.append(_unplane(batch.column(6)[i].as_py(), np.uint32))
        if cells:
            cell, count = np.concatenate(cells), np.concatenate(counts).astype(np.int64)
            order = np.argsort(cell)
            cell, count = cell[order], count[order]
            first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            total = np.add.reduceat(count, first)
            keep = total >= LEAST_FREQUENT
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(keep.sum(), np.int32)), pa.array(cell[first][keep].astype(np.int64)), pa.array(total[keep]),
                 pa.nulls(int(keep.sum()), pa.int64()), pa.nulls(int(keep.sum()), pa.int64())], names=["kind", "key", "n", "node", "text_hash"])

    dealt = docs.mapInArrow(lean(scan), "r int, kind int, key long, n long, node long, text_hash long, cells binary, counts binary").repartition("r")
    return materialize(dealt.drop("r").mapInArrow(lean(gather), "kind int, key long, n long, node long, text_hash long"), "ngram-counts")


def _classes(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted cells of class 2 and up, and of class 3."""
    cells = counted.where("kind = 1")
    by_power = cells.groupBy(F.floor(F.log2("n")).cast("int").alias("p")).agg(F.count("*").alias("m")).collect()
    power, passing = 63, 0
    for r in sorted(by_power, key=lambda r: -r["p"]):       # bounded: one row per power of two
        if passing + r["m"] > MOST_FREQUENT:
            break
        power, passing = r["p"], passing + r["m"]
    got = cells.where(F.col("n") >= F.lit(2.0 ** power)).select("key", "n").toArrow()      # bounded by MOST_FREQUENT
    key, n = got["key"].to_numpy().astype(np.uint32), got["n"].to_numpy()
    return np.sort(key), np.sort(key[n >= THIRD_CLASS * 2.0 ** power])


def _member(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(table, x), len(table) - 1)
    return table[at] == x


def signatures(tokens: np.ndarray, second: np.ndarray, third: np.ndarray, percent: int) -> np.ndarray:
    """The indexed combinations of a token set, as 64-bit hashes."""
    n = len(tokens)
    need = slack(n, percent) + 1
    if need <= 1 and 100 * n // percent == n:       # only an equal set can link, and that is the same node
        return np.zeros(0, np.uint64)
    cell = (tokens >> np.uint64(32)).astype(np.uint32)
    k = 1 + _member(cell, second).astype(np.int64) + _member(cell, third)
    rare = tokens[k == 1][:need]
    if len(rare) >= need:
        return rare
    out = [rare]
    for level in sorted({n.bit_length(), (100 * n // percent).bit_length()}):
        have = len(rare)
        for kind, groups in ((2, max(1, 2 ** (level - 1) // 4)), (3, max(1, 2 ** (level - 1) // 8))):
            mine = tokens[k == kind]
            if have >= need or not len(mine):
                continue
            group = (mix(mine) % np.uint64(groups)).astype(np.int64)
            order = np.lexsort((mine, group))
            mine, group = mine[order], group[order]
            edges = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(mine)]])
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                use = mine[a:min(b, a + kind - 1 + need - have)]
                if len(use) >= kind:
                    picks = np.array(list(combinations(range(len(use)), kind)))
                    with np.errstate(over="ignore"):
                        x = np.full(len(picks), level * 8 + kind, np.uint64)
                        for c in range(kind):
                            x = mix(x * np.uint64(0x9E3779B97F4A7C15) + use[picks[:, c]])
                    out.append(x)
                have += max(0, len(use) - kind + 1)
                if have >= need:
                    break
    return np.concatenate(out)


def _signature_pass(docs: DataFrame, second: np.ndarray, third: np.ndarray, size: int, percent: int) -> DataFrame:
    """``sig, node, n, leader`` and ``SKETCH``. Rows with a signature: the
    holders of every signature that several nodes share, each with a leader among the holders of its task, and these
    with one among all tasks. Rows without: the sketch of every node."""
    shared = docs.sparkSession.sparkContext.broadcast((second, third))
    entry = np.dtype([("sig", np.uint64), ("node", np.int64), ("n", np.uint32), ("share", np.uint32)])

    def leaders(e: np.ndarray):
        """Entries ordered by signature, then leader first; start of each signature; size."""
        # the leader has the largest share of frequent tokens: among copies with
        # different edits that is the one closest to what they are copies of
        e = e[np.lexsort((mix(e["node"].view(np.uint64)), np.uint32(1 << 20) - e["share"], e["sig"]))]
        first = np.flatnonzero(np.concatenate([[True], e["sig"][1:] != e["sig"][:-1]]))
        return e, first, np.diff(np.append(first, len(e)))

    def rows_of(e, first, count):
        """The entries of signatures held more than once, with their leader."""
        lead = np.repeat(e["node"][first], count)
        many = np.repeat(count > 1, count)
        e, lead = e[many], lead[many]
        return [pa.array(e["sig"].view(np.int64) if e["sig"].flags.c_contiguous else e["sig"].astype(np.int64)), pa.array(e["node"].copy()),
                pa.array(e["n"].astype(np.int64)), pa.array(lead.copy())]

    def no_sketch(n):
        return [pa.nulls(n, pa.int64()) for _ in SKETCH]

    def scan(batches):
        two, three = shared.value
        seen, held, known, bits = set(), [], [], []
        for batch in batches:
            for first, data, offsets in blocks(batch.column(1)) if batch.num_rows else ():
                for _, s in shingle_sets(data, offsets, size):
                    node = fingerprint(s)
                    if node in seen:
                        continue
                    seen.add(node)
                    known.append((node, len(s)))
                    bits.append(parity_bits(s))
                    sig = signatures(s, two, three, percent)
                    e = np.empty(len(sig), entry)
                    e["sig"], e["node"], e["n"] = sig, node, len(s)
                    e["share"] = (int(_member((s >> np.uint64(32)).astype(np.uint32), two).sum()) << 20) // len(s)
                    held.append(e)
        if not any(map(len, held)):
            return
        bits = np.array(bits)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(known)) % (1 << _RANGE_BITS), pa.int32()), pa.nulls(len(known), pa.int64()), pa.array([x for x, _ in known], pa.int64()),
             pa.array([x for _, x in known], pa.int64()), pa.nulls(len(known), pa.int64()),
             *(pa.array(np.ascontiguousarray(bits[:, i])) for i in range(len(SKETCH))), pa.nulls(len(known), pa.binary())],
            names=["r", "sig", "node", "n", "leader", *SKETCH, "entries"])
        e, first, count = leaders(np.concatenate(held))
        held.clear()
        own = rows_of(e, first, count)
        n = len(own[0])
        for a in range(0, n, 50_000):
            part = [c[a:a + 50_000] for c in own]
            yield pa.RecordBatch.from_arrays(
                [pa.array((np.arange(len(part[0])) + a) % (1 << _RANGE_BITS), pa.int32()), *part, *no_sketch(len(part[0])),
                 pa.nulls(len(part[0]), pa.binary())], names=["r", "sig", "node", "n", "leader", *SKETCH, "entries"])
        e = e[first]
        cut = np.searchsorted(e["sig"], np.arange(1, 1 << _RANGE_BITS, dtype=np.uint64) << np.uint64(64 - _RANGE_BITS))
        packed = [(r, e[a:b].tobytes()) for r, (a, b) in enumerate(zip(np.append(0, cut).tolist(), np.append(cut, len(e)).tolist())) if a < b]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r for r, _ in packed], pa.int32()), *(pa.nulls(len(packed), pa.int64()) for _ in range(4)), *no_sketch(len(packed)),
             pa.array([x for _, x in packed], pa.binary())], names=["r", "sig", "node", "n", "leader", *SKETCH, "entries"])

    def gather(batches):
        held = []
        for batch in batches:
            last = batch.num_columns - 1
            packed = batch.column(last).is_valid().to_numpy(zero_copy_only=False)
            plain = batch.filter(pa.array(~packed)).select(list(range(last)))
            if plain.num_rows:
                yield plain
            held += [np.frombuffer(batch.column(last)[i].as_py(), entry) for i in np.flatnonzero(packed).tolist()]
        if any(map(len, held)):
            cols = rows_of(*leaders(np.concatenate(held)))
            yield pa.RecordBatch.from_arrays([*cols, *no_sketch(len(cols[0]))], names=["sig", "node", "n", "leader", *SKETCH])

    kept = "sig long, node long, n long, leader long, " + ", ".join(f"{c} long" for c in SKETCH)
    dealt = docs.mapInArrow(lean(scan), f"r int, {kept}, entries binary").repartition("r")
    return materialize(dealt.drop("r").mapInArrow(lean(gather), kept), "ngram-signatures")


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` of nodes whose texts' sets link. ``texts``: node, text."""
    both = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b") \
        .join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").select("a", "b", "text_a", "text_b")

    def check(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            last, keep = (None, None), np.zeros(len(a), bool)
            left, right = batch.column(2), batch.column(3)
            for first, data, offsets in blocks(right):
                sets = dict(shingle_sets(data, offsets, size))
                for r in range(len(offsets) - 1):
                    i = first + r
                    if a[i] != last[0]:                      # the join leaves equal left ends together
                        last = (a[i], next(s for _, d, o in blocks(left.slice(i, 1)) for _, s in shingle_sets(d, o, size)))
                    x, y = last[1], sets[r]
                    common = int(_member(y, x).sum())
                    keep[i] = 100 * common >= percent * (len(x) + len(y) - common)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])

    return both.mapInArrow(lean(check), "a long, b long")


def _resigned(nodes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The partition signatures of ``node, root``."""
    def run(batches):
        for batch in batches:
            for first, data, offsets in blocks(batch.column(2)) if batch.num_rows else ():
                for r, s in shingle_sets(data, offsets, size):
                    yield resigned(batch.column(0)[first + r].as_py(), batch.column(1)[first + r].as_py(), s, percent)

    return nodes.join(texts, "node").select("node", "root", "text").mapInArrow(lean(run), RESIGNED)


def ngram_links(docs: DataFrame, size: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(members, roots)``: ``members`` has ``doc_id, text_hash, n, node`` of every
    document, ``roots`` has ``node, root`` of the nodes that links lead to a
    smaller one."""
    rows = _texts(docs, id_col, text_col)
    counted = _count_pass(rows, size)
    members = counted.where("kind = 0").select(F.col("key").alias("doc_id"), "text_hash", "n", "node")
    signed = _signature_pass(rows.where("doc_id IS NOT NULL"), *_classes(counted), size, percent)
    held = signed.where("sig IS NOT NULL").drop(*SKETCH)
    sketches = signed.where("sig IS NULL").select("node", *SKETCH).dropDuplicates(["node"])
    # one text for every node that is a candidate anywhere
    one = members.where("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("d"))
    wanted = held.select("node").distinct().join(one, "node").select("node", "d.doc_id", "d.text_hash")
    # by id and text: an id may stand for several texts, and repeated rows give a node twice
    texts = materialize(rows.join(wanted, ["doc_id", "text_hash"]).select("node", "text").dropDuplicates(["node"]), "ngram-texts")
    return members, close_links(held, sketches, percent, lambda pairs: _verified(pairs, texts, size, percent), lambda nodes: _resigned(nodes, texts, size, percent))


def ngram_components(docs: DataFrame, size: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, text_hash, n_shingles, component_id``
    (the smallest document id that links reach, the own one included)."""
    members, roots = ngram_links(docs, size, percent, id_col, text_col)
    nodes = members.where("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"))
    nodes = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # written, so that the planner can split a large component in the join
    least = materialize(nodes.groupBy("root").agg(F.min("least").alias("component_id")), "ngram-components")
    by_node = nodes.select("node", "root").join(least, "root").select("node", "component_id")
    return members.join(by_node, "node", "left").select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, size: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id;
    of repeated rows (equal id and text) one stays. Documents without an id or
    without words all stay. All columns stay."""
    found = ngram_components(docs, size, percent, id_col, text_col).where("doc_id IS NOT NULL AND doc_id <> component_id")
    gone = found.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    marked, own = docs.withColumns({"__own": F.col(f"`{id_col}`").cast("long"), "__text": F.xxhash64(F.col(f"`{text_col}`"))}), [f"`{c}`" for c in docs.columns]
    left = marked.join(gone, (F.col("__own") == F.col("__id")) & (F.col("__text") == F.col("__hash")), "left_anti")
    turn = F.row_number().over(Window.partitionBy("__own", "__text").orderBy("__text"))
    some = left.where("__own IS NOT NULL").withColumn("__turn", turn).where("__turn = 1")
    return some.select(*own).unionByName(left.where("__own IS NULL").select(*own))
