"""Substring dedup by exact word windows and paragraph MinHash banding.

Exact passages. Every window of ``WINDOW`` words has a hash; of each ``SPREAD``
windows in a row the least hash is a seed, so two documents that share
``WINDOW + SPREAD - 1`` words one after another share a seed, wherever these
stand and however their lines break. All windows within ``CONTEXT`` words of a
seed that two documents share are then compared with each other, which finds
shared passages word by word to both their ends.

Near copies. Paragraphs are lines, and stretches of lines of fewer than
``SHINGLE`` words, so nothing outside a text decides where it is cut. A
paragraph's set holds its distinct shingles of ``SHINGLE`` words; paragraphs
with fewer words have none. Every distinct set is dealt by ``bands`` MinHash
keys (``band_plan`` finds the number that reaches the wanted recall at the
similarity threshold); a task sends a set once per key, so a very common
paragraph is never gathered. All paragraphs meet the sets that occur more than
once or share a key with another set; the latter are built again from the text
of one place each and verified by exact Jaccard. Components of verified links are clusters.

A window or cluster that occurs in more than one document keeps its first place
(smallest document id, then text hash and position); the others are removals.
Words that a kept window covers are not removed by other windows. Repeated
words with at most ``REACH`` others between them form a run; runs of fewer than
``LEAST_WORDS`` repeated words are left alone.

NULL and empty texts have no words. Documents without an id are left out. Rows
are told apart by id and text: equal rows count once, and rows that share an
id, whatever their texts, are one document to which its own repeats do not
count. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import RESIGNED, SKETCH, close_links, parity_bits, resigned
from tidemark.llm.shared_places import shared_places, unpack, unpack_ids
from tidemark.llm.textblocks import blocks, lower_ascii, mix, span_hashes, words
from tidemark.session import materialize

SHINGLE = 5
SIMILARITY = 0.8
REACH = 6
WINDOW = 12
SPREAD = 12                      # at most WINDOW: the words of a text's end keep its windows from the next text's
CONTEXT = 32
LEAST_WORDS = 25
RECALL = 0.99
_RANGE_BITS = 12


def band_plan(similarity: float, recall: float, rows: int = 1) -> int:
    """The least number of bands of ``rows`` MinHashes that finds a pair of
    that similarity with that probability."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity ** rows)))


def paragraphs(data: np.ndarray, offsets: np.ndarray):
    """``(starts, ends, row, first, n, hashes)``: the words of a block with
    their hashes, and the first word and number of words of every paragraph:
    a line, or all lines of fewer than ``SHINGLE`` words that follow each other."""
    low = lower_ascii()[data]
    starts, ends, row = words(low, offsets, "space")
    if not len(starts):
        z = np.zeros(0, np.int64)
        return starts, ends, row, z, z, np.zeros(0, np.uint64)
    h = span_hashes(low, starts, ends)
    newline = np.concatenate([[0], np.cumsum(data == 0x0A)])
    cut = np.ones(len(h), bool)
    cut[1:] = (row[1:] != row[:-1]) | (newline[starts[1:]] != newline[starts[:-1]])
    first = np.flatnonzero(cut)
    short = np.diff(np.append(first, len(h))) < SHINGLE
    joined = np.append(False, short[1:] & short[:-1] & (row[first[1:]] == row[first[:-1]]))
    first = first[~joined]
    return starts, ends, row, first, np.diff(np.append(first, len(h))), h


def paragraph_sets(data: np.ndarray, offsets: np.ndarray, begins=None):
    """Paragraphs with at least one shingle: ``(starts, ends, row, first, n,
    shingle hashes one after another, shingles per paragraph)``, the first five
    as of ``paragraphs``; the shingles are sorted and distinct inside each one.
    ``begins`` (the row of every word to numbers of words): only the paragraphs
    that begin there."""
    starts, ends, row, first, n, h = paragraphs(data, offsets)
    keep = n >= SHINGLE
    if begins is not None:
        keep &= np.isin(first, begins(row))
    first, n = first[keep], n[keep]
    if not len(first):
        z = np.zeros(0, np.int64)
        return starts, ends, row, first, n, np.zeros(0, np.uint64), z
    with np.errstate(over="ignore"):
        whole = np.zeros(len(h) - SHINGLE + 1, np.uint64)
        for i in range(SHINGLE):
            whole = whole * np.uint64(0xD6E8FEB86659FD93) + h[i:len(h) - SHINGLE + 1 + i]
    whole = mix(whole)
    many = n - SHINGLE + 1
    owner = np.repeat(np.arange(len(n)), many)
    at = np.cumsum(many) - many
    flat = whole[np.repeat(first - at, many) + np.arange(int(many.sum()))]
    order = np.argsort(flat)
    # few paragraphs, whose numbers are sorted by digits
    order = order[np.argsort(owner[order].astype(np.uint16 if len(n) <= 1 << 16 else np.int64), kind="stable")]
    flat, owner = flat[order], owner[order]
    distinct = np.ones(len(flat), bool)
    distinct[1:] = (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])
    flat, many = flat[distinct], np.bincount(owner[distinct], minlength=len(n))
    return starts, ends, row, first, n, flat, many


def _nodes(flat: np.ndarray, many: np.ndarray) -> np.ndarray:
    """A 64-bit fingerprint of each paragraph's set."""
    at = np.cumsum(many) - many
    with np.errstate(over="ignore"):
        return mix(np.add.reduceat(mix(flat ^ np.uint64(0xA0761D6478BD642F)), at) + many.astype(np.uint64)).view(np.int64)


PLACE = ["at", "words"]          # the number of the first word in its text, and of words; the rest is found again from the text


def _places(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray, first: np.ndarray, n) -> list[np.ndarray]:
    """Places of runs of ``n`` words from word ``first`` on: the word's
    number in its text, the number of words, and in code points of the text the
    end of the word before, start, end, and the start of the word after."""
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    base = heads[offsets[row[first]]]
    last = first + n - 1
    after = starts[np.minimum(last + 1, len(starts) - 1)]
    at = first - np.searchsorted(row, row[first])
    out = [at, np.broadcast_to(n, at.shape), heads[ends[first - 1]] - base, heads[starts[first]] - base, heads[ends[last]] - base, heads[after] - base]
    return [x.astype(np.int32) for x in out]


def windows(data: np.ndarray, offsets: np.ndarray):
    """``(starts, ends, row, hashes, whole)``: the words of a block and for each
    the hash of the ``WINDOW`` words from it on; ``whole`` tells which of these
    end in the same row."""
    low = lower_ascii()[data]
    starts, ends, row = words(low, offsets, "space")
    hashes, whole = np.zeros(len(starts), np.uint64), np.zeros(len(starts), bool)
    many = len(starts) - WINDOW + 1
    if many > 0:
        h = span_hashes(low, starts, ends)
        with np.errstate(over="ignore"):
            for i in range(WINDOW):
                hashes[:many] = hashes[:many] * np.uint64(0xD6E8FEB86659FD93) + h[i:i + many]
        hashes = mix(hashes)
        whole[:many] = row[:many] == row[WINDOW - 1:]
    return starts, ends, row, hashes, whole


def seeds(row: np.ndarray, hashes: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """The windows that are the least (the first of equal ones) of ``SPREAD``
    windows in a row, or of all windows of a text with fewer."""
    if not whole.any():
        return np.zeros(0, np.int64)
    padded = np.append(np.where(whole, hashes, np.iinfo(np.uint64).max), np.full(SPREAD - 1, np.iinfo(np.uint64).max, np.uint64))
    least = np.lib.stride_tricks.sliding_window_view(padded, SPREAD).argmin(axis=1)
    full = whole & np.append(whole[SPREAD - 1:], np.zeros(SPREAD - 1, bool))[:len(whole)]
    full &= np.append(row[SPREAD - 1:], np.full(SPREAD - 1, -1))[:len(row)] == row
    head = whole & np.append(True, row[1:] != row[:-1])
    i = np.flatnonzero(full | head)
    return np.unique(i + least[i])


def _seed_keys(batch: pa.RecordBatch):
    for base, data, offsets in blocks(batch.column(2)):
        _, _, row, hashes, whole = windows(data, offsets)
        i = seeds(row, hashes, whole)
        yield base + row[i], hashes[i], i - np.searchsorted(row, row[i])


def _window_keys(batch: pa.RecordBatch):
    """The windows within ``CONTEXT`` words of the places in the last column."""
    each, flat, _ = unpack(batch.column(3))
    upto = np.append(0, np.cumsum(each))
    for base, data, offsets in blocks(batch.column(2)):
        starts, _, row, hashes, whole = windows(data, offsets)
        rows_here = len(offsets) - 1
        edge = np.searchsorted(row, np.arange(rows_here + 1))
        of = np.repeat(np.arange(rows_here), np.diff(upto[base:base + rows_here + 1]))
        at = flat[upto[base]:upto[base + rows_here]] + edge[of]
        depth = np.zeros(len(starts) + 1, np.int64)
        np.add.at(depth, np.maximum(at - CONTEXT, edge[of]), 1)
        np.add.at(depth, np.minimum(at + CONTEXT + 1, edge[of + 1]), -1)
        i = np.flatnonzero(whole & (np.cumsum(depth[:-1]) > 0))
        yield base + row[i], hashes[i], i - edge[row[i]]


def _window_texts(rows: DataFrame) -> DataFrame:
    """The windows of ``repeated_windows``, one row per text, as of ``shared_places``."""
    met = shared_places(rows, _seed_keys, "seeds").select("doc_id", "text_hash", F.col("places").alias("near"))
    near = rows.join(met, ["doc_id", "text_hash"]).select("doc_id", "text_hash", "text", "near")
    return shared_places(near, _window_keys, "windows")


def repeated_windows(rows: DataFrame) -> DataFrame:
    """One row per window of ``WINDOW`` words that another document has as
    well, near a seed that documents share: ``doc_id, text_hash``, ``at`` (the
    number of its first word), ``kept_in`` and ``kept`` as of
    ``repeated_paragraphs``. Most of a job's rows are such windows; the rest of
    their places is found again from the text."""
    def rows_of(batches):
        for batch in batches:
            many, at, kept = unpack(batch.column(2))
            ids, texts = (np.repeat(batch.column(i).to_numpy(), many) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, texts, at.astype(np.int32), unpack_ids(batch.column(3)), kept)],
                                             names=["doc_id", "text_hash", "at", "kept_in", "kept"])

    return _window_texts(rows).mapInArrow(rows_of, "doc_id long, text_hash long, at int, kept_in long, kept boolean")


def _with_first(placed: DataFrame, key: str) -> DataFrame:
    """The rows of keys that occur in more than one document, with ``kept_in``
    and ``kept``."""
    first = placed.groupBy(key).agg(F.min(F.struct("doc_id", "text_hash", "at")).alias("f"), F.max("doc_id").alias("last")) \
        .where("f.doc_id < last").select(key, F.col("f.doc_id").alias("kept_in"), F.col("f.text_hash").alias("kept_text"), F.col("f.at").alias("kept_at"))
    first = materialize(first, "places-first")
    kept = (F.col("doc_id") == F.col("kept_in")) & (F.col("text_hash") == F.col("kept_text")) & (F.col("at") == F.col("kept_at"))
    return placed.join(first, key).withColumn("kept", kept).drop("kept_text", "kept_at")


def _shared_keys(docs: DataFrame, bands: int) -> DataFrame:
    """``sig, node, n, leader``: the sets that share a band's key with another;
    rows with ``leader`` NULL: sets that occur more than once."""
    entry = np.dtype([("key", np.uint64), ("node", np.int64), ("n", np.uint32), ("count", np.uint32)])

    def scan(batches):
        held: list = []
        for batch in batches:
            for _, data, offsets in blocks(batch.column(2)) if batch.num_rows else ():
                *_, flat, many = paragraph_sets(data, offsets)
                if not len(many):
                    continue
                at = np.cumsum(many) - many
                node, first, count = np.unique(_nodes(flat, many), return_index=True, return_counts=True)
                keys = [np.minimum.reduceat(mix(flat + np.uint64((b + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)), at)[first] for b in range(bands)]
                held.append((node, many[first], count, keys))
        if not held:
            return
        node, first, back = np.unique(np.concatenate([x[0] for x in held]), return_index=True, return_inverse=True)
        count = np.bincount(back, weights=np.concatenate([x[2] for x in held])).astype(np.uint32)
        n = np.concatenate([x[1] for x in held])[first]
        for b in range(bands):
            e = np.empty(len(node), entry)
            e["key"] = np.concatenate([x[3][b] for x in held])[first]
            e["node"], e["n"], e["count"] = node, n, count if b == 0 else 0
            e = e[np.argsort(e["key"])]
            cut = np.searchsorted(e["key"], np.arange(1, 1 << _RANGE_BITS, dtype=np.uint64) << np.uint64(64 - _RANGE_BITS))
            edges = list(zip(np.append(0, cut).tolist(), np.append(cut, len(e)).tolist()))
            rows = [(r, e[i:j]) for r, (i, j) in enumerate(edges) if i < j]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r for r, _ in rows], pa.int32()), pa.array([b] * len(rows), pa.int32()),
                 pa.array([b"".join((x["key"].tobytes(), x["node"].tobytes(), x["n"].tobytes(),
                                     x["count"].tobytes() if b == 0 else b"")) for _, x in rows], pa.binary())], names=["r", "band", "entries"])

    def gather(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for band, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                size = len(raw) // (24 if band == 0 else 20)
                e = np.empty(size, entry)
                e["key"] = np.frombuffer(raw, np.uint64, size)
                e["node"] = np.frombuffer(raw, np.int64, size, 8 * size)
                e["n"] = np.frombuffer(raw, np.uint32, size, 16 * size)
                e["count"] = np.frombuffer(raw, np.uint32, size, 20 * size) if band == 0 else 0
                held.setdefault(band, []).append(e)
        for band, parts in held.items():
            e = np.concatenate(parts)
            parts.clear()
            e = e[np.lexsort((e["node"], e["key"]))]
            own = np.flatnonzero(np.concatenate([[True], (e["node"][1:] != e["node"][:-1]) | (e["key"][1:] != e["key"][:-1])]))
            total = np.add.reduceat(e["count"].astype(np.int64), own)
            e = e[own]
            out = []
            if band == 0:
                again = e[total > 1]
                out.append((again, None))
            e = e[np.lexsort((mix(e["node"].view(np.uint64)), e["key"]))]
            first = np.flatnonzero(np.concatenate([[True], e["key"][1:] != e["key"][:-1]]))
            many = np.diff(np.append(first, len(e)))
            shared = np.repeat(many > 1, many)
            out.append((e[shared], np.repeat(e["node"][first], many)[shared]))
            for x, leader in out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mix(x["key"] + np.uint64(band)).view(np.int64)), pa.array(x["node"].copy()), pa.array(x["n"].astype(np.int64)),
                     pa.nulls(len(x), pa.int64()) if leader is None else pa.array(leader)], names=["sig", "node", "n", "leader"])

    dealt = docs.mapInArrow(scan, "r int, band int, entries binary").repartition("r")
    return materialize(dealt.select("band", "entries").mapInArrow(gather, "sig long, node long, n long, leader long"), "paragraph-keys")


def _all_paragraphs(docs: DataFrame) -> DataFrame:
    """``node, doc_id, text_hash`` and ``PLACE`` of every paragraph with a
    shingle."""
    def scan(batches):
        for batch in batches:
            ids, texts = (batch.column(i).to_numpy() for i in (0, 1)) if batch.num_rows else ((), ())
            for base, data, offsets in blocks(batch.column(2)) if batch.num_rows else ():
                _, _, row, first, n, flat, many = paragraph_sets(data, offsets)
                if not len(first):
                    continue
                mine = row[first]
                place = [x.astype(np.int32) for x in (first - np.searchsorted(row, mine), n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_nodes(flat, many)), pa.array(ids[base + mine]), pa.array(texts[base + mine]), *map(pa.array, place)],
                    names=["node", "doc_id", "text_hash", *PLACE])

    return docs.mapInArrow(scan, "node long, doc_id long, text_hash long, at int, words int")


def _sets(rows: DataFrame, placed: DataFrame) -> DataFrame:
    """``node`` and ``tokens``, the sorted shingle hashes, of every node in
    ``placed`` (``node, doc_id, text_hash, at``), from the text of its first place."""
    one = placed.groupBy("node").agg(F.min(F.struct("doc_id", "text_hash", "at")).alias("p"))
    of = one.groupBy("p.doc_id", "p.text_hash").agg(F.collect_list("p.at").alias("begins"))

    def build(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            upto, flat = batch.column(1).offsets.to_numpy().astype(np.int64), batch.column(1).values.to_numpy().astype(np.int64)
            for base, data, offsets in blocks(batch.column(0)):
                here = upto[base:base + len(offsets)]

                def begins(row, here=here, last=len(offsets) - 1):
                    return flat[here[0]:here[-1]] + np.repeat(np.searchsorted(row, np.arange(last)), np.diff(here))

                *_, tokens, many = paragraph_sets(data, offsets, begins)
                if len(many):
                    edge, raw = np.concatenate([[0], np.cumsum(many)]) * 8, tokens.tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(_nodes(tokens, many)), pa.array([raw[i:j] for i, j in zip(edge[:-1].tolist(), edge[1:].tolist())], pa.binary())],
                        names=["node", "tokens"])

    # equal rows give a node's set twice
    return rows.join(of, ["doc_id", "text_hash"]).select("text", "begins").mapInArrow(build, "node long, tokens binary").dropDuplicates(["node"])


def _sketches(sets: DataFrame) -> DataFrame:
    """``node`` and the parity sketch of each set."""
    def run(batches):
        for batch in batches:
            bits = np.array([parity_bits(np.frombuffer(t, np.uint64)) for t in batch.column(1).to_pylist()], np.int64).reshape(-1, len(SKETCH))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(np.ascontiguousarray(bits[:, i])) for i in range(len(SKETCH)))], names=["node", *SKETCH])

    return sets.select("node", "tokens").mapInArrow(run, "node long, " + ", ".join(f"{c} long" for c in SKETCH))


def _resigned(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """The partition signatures of ``node, root``."""
    def run(batches):
        for batch in batches:
            for node, root, tokens in zip(*(batch.column(i).to_pylist() for i in range(3))):
                yield resigned(node, root, np.frombuffer(tokens, np.uint64), round(SIMILARITY * 100))

    return nodes.join(sets, "node").select("node", "root", "tokens").mapInArrow(run, RESIGNED)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sets have a Jaccard similarity of at least ``SIMILARITY``."""
    def check(batches):
        for batch in batches:
            a, b, x, y = (batch.column(i).to_pylist() for i in range(4))
            keep = []
            for u, v in zip(x, y):
                u, v = np.frombuffer(u, np.uint64), np.frombuffer(v, np.uint64)
                common = len(np.intersect1d(u, v, assume_unique=True))
                keep.append(common >= SIMILARITY * (len(u) + len(v) - common) - 1e-9)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()).filter(pa.array(keep, pa.bool_())) for c in (a, b)], names=["a", "b"])

    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a") \
        .join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    return rows.where("doc_id IS NOT NULL")


def repeated_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", recall: float = RECALL) -> DataFrame:
    """One row per repeated paragraph: ``doc_id, text_hash``, ``PLACE``,
    ``cluster`` and ``kept_in`` (the document that keeps the cluster's first
    paragraph), ``kept`` (this is that paragraph)."""
    rows = _rows(docs, id_col, text_col)
    found = _shared_keys(rows, band_plan(SIMILARITY, recall))
    held = found.where("leader IS NOT NULL")
    # written, as are the first places, so that the planner can split a hot paragraph in the join
    wanted = materialize(found.groupBy("node").agg(F.max(F.col("leader").isNotNull()).alias("candidate")), "paragraph-nodes")
    met = materialize(_all_paragraphs(rows).join(wanted, "node"), "paragraphs")
    sets = materialize(_sets(rows, met.where("candidate")), "paragraph-sets")
    roots = close_links(held, _sketches(sets), round(SIMILARITY * 100), lambda pairs: _verified(pairs, sets), lambda nodes: _resigned(nodes, sets))
    placed = met.drop("candidate").join(roots, "node", "left").withColumn("cluster", F.coalesce("root", "node")).drop("root", "node")
    return _with_first(materialize(placed, "paragraphs-placed"), "cluster")


def merged_runs(at, words, before, start, end, after, kept, exact, kept_in, least_words: int):
    """``(n_repeated, n_removed, removed, kept_in)`` of one text from its
    repeated windows (``exact``) and paragraphs, or None without a run."""
    low, stop = int(at.min()), at + words
    size = int(stop.max()) - low

    def covered(rows):
        depth = np.zeros(size + 1, np.int64)
        np.add.at(depth, at[rows] - low, 1)
        np.add.at(depth, stop[rows] - low, -1)
        return np.cumsum(depth[:-1]) > 0

    repeated = covered(slice(None))
    word = np.flatnonzero(repeated)
    run = np.concatenate([[0], np.cumsum(np.diff(word) > REACH + 1)])
    good = np.zeros(size, bool)
    good[word[np.bincount(run)[run] >= least_words]] = True
    if not good.any():
        return None
    gone = good & ((covered(exact & ~kept) & ~covered(exact & kept)) | covered(~exact & ~kept))
    # a span begins where a row does or the one before ends, and ends likewise
    begins, ends = np.zeros(size + 1, np.int64), np.zeros(size + 1, np.int64)
    begins[stop - low] = after
    begins[at - low] = start
    ends[at - low] = before
    ends[stop - low] = end
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    spans = [{"start": a, "end": b} for a, b in zip(begins[edges[::2]].tolist(), ends[edges[1::2]].tolist())]
    return int(good.sum()), int(gone.sum()), spans, np.unique(kept_in[good[at - low]]).tolist()


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """One row per document text with a repeated run of at least ``least_words``
    words: ``doc_id, text_hash, n_repeated`` and ``n_removed`` (words),
    ``removed`` (spans ``start, end`` in code points to cut) and ``kept_in``
    (documents that keep what it repeats)."""
    # a paragraph is two numbers on its way to its text; a text has fewer than 2 ** 30 words
    place = F.expr("shiftleft(cast(at AS long), 32) + shiftleft(cast(words AS long), 1) + IF(kept, 1, 0)").alias("place")
    rows = _rows(docs, id_col, text_col)
    near = repeated_paragraphs(docs, id_col, text_col).select("doc_id", "text_hash", place, "kept_in")
    near = near.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("place", "kept_in")).alias("p"))
    # written, so that what they have shuffled does not lie beside the texts
    found = materialize(_window_texts(rows), "windows-repeated")
    runs = near.join(found, ["doc_id", "text_hash"], "full_outer")

    def merge(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            out = {"doc_id": [], "text_hash": [], "n_repeated": [], "n_removed": [], "removed": [], "kept_in": []}
            (many, win, win_kept), win_in = unpack(batch.column(4)), unpack_ids(batch.column(5))
            p = batch.column(3)
            each = np.diff(p.offsets.to_numpy().astype(np.int64))
            place, kept_in = (x.to_numpy() for x in p.flatten().flatten())
            # a text's windows and paragraphs one after another
            turn = np.argsort(np.repeat(np.append(np.arange(len(many)), np.arange(len(each))), np.append(many, each)), kind="stable")
            edge = np.append(0, np.cumsum(many + each))
            at, n = (np.append(x, y)[turn] for x, y in ((win, place >> 32), (np.full(len(win), WINDOW), (place & 0xFFFFFFFF) >> 1)))
            parts = [np.append(x, y)[turn] for x, y in ((win_kept, (place & 1) > 0), (np.ones(len(win), bool), np.zeros(len(place), bool)), (win_in, kept_in))]
            doc_ids, texts = (batch.column(i).to_pylist() for i in (0, 1))
            for base, data, offsets in blocks(batch.column(2)):
                starts, ends, row = words(data, offsets, "space")
                here = edge[base:base + len(offsets)]
                mine = slice(here[0], here[-1])
                first = at[mine] + np.repeat(np.searchsorted(row, np.arange(len(offsets) - 1)), np.diff(here))
                places = _places(data, offsets, starts, ends, row, first, n[mine])
                for k, (i, j) in enumerate(zip(here[:-1].tolist(), here[1:].tolist()), base):
                    got = merged_runs(*(x[i - here[0]:j - here[0]] for x in places), *(x[i:j] for x in parts), least_words)
                    if got:
                        for name, x in zip(out, (doc_ids[k], texts[k], *got)):
                            out[name].append(x)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_repeated", pa.int64()), ("n_removed", pa.int64()),
                ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_in", pa.list_(pa.int64()))]))

    placed = rows.join(runs, ["doc_id", "text_hash"]).select("doc_id", "text_hash", "text", "p", "places", "kept_in")
    # equal rows met the same places
    return placed.mapInArrow(merge, "doc_id long, text_hash long, n_repeated long, n_removed long, "
                                    "removed array<struct<start:long,end:long>>, kept_in array<long>").dropDuplicates(["doc_id", "text_hash"])


def without_repeats(docs: DataFrame, removals: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the removals of ``substring_dedup`` cut from their texts,
    matched by id and text; all rows and columns stay."""
    gone = removals.where("n_removed > 0").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("removed").alias("__removed"))
    text = F.col(f"`{text_col}`")
    cut = F.aggregate("__removed", F.struct(F.lit("").alias("t"), F.lit(0).cast("long").alias("at")), lambda acc, s: F.struct(
        F.concat(acc["t"], F.substring(text, acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int"))).alias("t"),
        s["end"].alias("at")), lambda acc: F.concat(acc["t"], F.substring(text, acc["at"].cast("int") + 1, F.char_length(text))))
    both = docs.join(gone, (F.col(f"`{id_col}`").cast("long") == F.col("__id")) & (F.xxhash64(text) == F.col("__hash")), "left")
    return both.withColumn(text_col, F.when(F.col("__id").isNotNull(), cut).otherwise(text)).select(*(f"`{c}`" for c in docs.columns))
