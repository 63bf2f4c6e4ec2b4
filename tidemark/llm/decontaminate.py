"""Benchmark decontamination with DataFrame functions only.

The benchmark's windows (runs of ``WINDOW`` normalised words; a shorter item is
one window) form a hash set that is broadcast after a check of its size. Every
document window is hashed inside its row and looked up in the set; a hit is
verified against the window's words, so hash collisions do not count. Texts are
scanned once and never shuffled: only one small row per document and the hits
are. For a benchmark of more than ``BROADCAST_BYTES`` the windows' hashes alone
(document, place, hash; no words) are dealt out and looked up; the documents with
hits are then read again and just their hit windows verified.

Words: A-Z are lower-cased, then runs of characters other than ASCII
non-alphanumerics. NULL and empty texts have no words; NULL or word-less items
have no window; a NULL item id marks words as hit but is not listed. Repeated
rows each get a row. Other columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import broadcast_if_small, materialize

WINDOW = 10
BROADCAST_BYTES = 64 * 1024 * 1024                       # of the benchmark's windows with their words and items
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"           # fixed value: what stands between words
_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; ``lower`` does just that to pure ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words(text: Column) -> Column:
    """The normalised words of a text (NULL: none)."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _window_hashes(hashes: Column, n: Column, length: int) -> Column:
    """The hash of every run of ``length`` words, by its first word."""
    runs = F.transform(F.sequence(F.lit(0), n - length),
                       lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(length)]))
    return F.when(n >= length, runs).otherwise(F.array().cast("array<bigint>"))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``h, win, items``: one row per distinct window with the ids of its items."""
    items = benchmark.select(F.col(id_col).alias("item"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    items = items.withColumn("len", F.least(F.size("w"), F.lit(window)))
    each = items.select("item", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("w") - F.col("len") + 1), lambda i: F.slice("w", i, F.col("len")))).alias("win"))
    return each.groupBy("win").agg(F.collect_set(F.col("item").cast("string")).alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, text_hash, n_words, n_hit, items``
    (sorted as strings) and ``hit_spans`` (first word, end), merged."""
    wins = benchmark_windows(benchmark, window, item_col, item_text_col)
    # bounded: at most `window` numbers
    lengths = sorted((r[0] for r in wins.select(F.size("win")).distinct().collect()), reverse=True)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w"))
    rows = rows.withColumns({"n": F.size("w"), "hashes": F.transform("w", lambda w: F.xxhash64(w))})
    n = F.col("n")
    # slot 0 stands for the document itself, then all windows, longest first
    runs = [_window_hashes(F.col("hashes"), n, k) for k in lengths]
    rows = rows.select("row", "doc_id", "text_hash", "n", "w", F.concat(F.array(F.lit(None).cast("bigint")), *runs).alias("hs"))
    # outer: else the optimizer adds a size filter that hashes every window once more
    slots = rows.select("row", "doc_id", "text_hash", "n", "w", F.posexplode_outer("hs").alias("slot", "h"))
    at, length, base = F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(1)
    steps = []
    for k in lengths:
        steps.append((base, k))
        base = base + F.greatest(n - k + 1, F.lit(0))
    for base, k in steps:                                  # later lengths start further on
        at = F.when(F.col("slot") >= base, F.col("slot") - base).otherwise(at)
        length = F.when(F.col("slot") >= base, F.lit(k)).otherwise(length)
    hashed = wins.select(F.when(F.size("win") > 0, F.col("win")).alias("win"), "items")
    h = F.lit(None).cast("bigint")
    for k in lengths:
        h = F.when(F.size("win") == k, F.xxhash64(*[F.xxhash64(F.get("win", F.lit(i))) for i in range(k)])).otherwise(h)
    hashed = hashed.withColumn("key", h)
    held = F.octet_length(F.array_join("win", " ")) + F.octet_length(F.array_join("items", ",")) + 16 * (F.size("win") + F.size("items") + 6)
    spans = F.collect_set(F.when(F.col("slot") > 0, F.struct(F.col("at").alias("s"), (F.col("at") + F.col("len")).alias("e")))).alias("hits")
    listed = F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(F.col("slot") > 0, F.col("items")))))).alias("items")
    if (hashed.agg(F.sum(held)).first()[0] or 0) <= BROADCAST_BYTES:
        met = slots.join(F.broadcast(hashed), F.col("h") == F.col("key"), "left").select(
            "row", "doc_id", "text_hash", "n", "slot", at.alias("at"), length.alias("len"), "items",
            F.when(F.col("slot") == 0, True).when(F.col("win").isNull(), False).otherwise(
                F.slice("w", at + 1, length) == F.col("win")).alias("counts")).where("counts")
        whole = met.groupBy("row").agg(
            F.first("doc_id", ignorenulls=True).alias("doc_id"), F.first("text_hash").alias("text_hash"),
            F.first("n").cast("long").alias("n_words"), spans, listed)
    else:
        whole = _looked_up(rows, slots, materialize(hashed, "benchmark-windows"), at, length, spans, listed)
    merged = F.aggregate(
        F.array_sort("hits"), F.array().cast("array<struct<s:int,e:int>>"),
        lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["e"] >= x["s"]),
                              F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                                  F.element_at(acc, -1)["s"].alias("s"), F.greatest(F.element_at(acc, -1)["e"], x["e"]).alias("e")))))
        .otherwise(F.concat(acc, F.array(x))))
    out = whole.select("doc_id", "text_hash", "n_words", "items", F.when(F.size("hits") > 0, merged).otherwise(
        F.array().cast("array<struct<s:int,e:int>>")).alias("hit_spans"))
    covered = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda acc, x: acc + (x["e"] - x["s"]))
    return out.select("doc_id", "text_hash", "n_words", covered.alias("n_hit"), "items", "hit_spans")


def window_hits(slots: DataFrame, windows: DataFrame) -> DataFrame:
    """``doc_id, text_hash, slot`` of the document windows whose hash is one of
    ``windows``; no words are dealt out."""
    asked = slots.where("h IS NOT NULL").select("doc_id", "text_hash", "slot", "h")
    return asked.join(windows.select(F.col("key").alias("h")).distinct(), "h", "left_semi").select("doc_id", "text_hash", "slot").distinct()


def _looked_up(rows: DataFrame, slots: DataFrame, windows: DataFrame, at: Column, length: Column, spans: Column, listed: Column) -> DataFrame:
    """``doc_id, text_hash, n_words, hits, items`` of every document with a set
    of windows too large to broadcast. Rows of equal id and text have equal hits."""
    def same(x: DataFrame) -> Column:
        return F.col("doc_id").eqNullSafe(x["__id"]) & F.col("text_hash").eqNullSafe(x["__hash"])

    def named(x: DataFrame) -> DataFrame:
        return x.withColumnsRenamed({"doc_id": "__id", "text_hash": "__hash"})

    found = broadcast_if_small(named(materialize(window_hits(slots, windows), "benchmark-hits")))
    # the hit windows themselves, a few words each
    hit = rows.join(found, same(found)).select("doc_id", "text_hash", "slot", at.alias("at"), length.alias("len"), F.slice("w", at + 1, length).alias("own"),
                                               F.get("hs", F.col("slot")).alias("h")).distinct()
    met = hit.join(windows, (F.col("h") == F.col("key")) & (F.col("own") == F.col("win"))).groupBy("doc_id", "text_hash").agg(spans, listed)
    met = broadcast_if_small(named(materialize(met, "benchmark-met")))
    nothing = {"hits": F.array().cast("array<struct<s:int,e:int>>"), "items": F.array().cast("array<string>")}
    return rows.select("doc_id", "text_hash", F.col("n").cast("long").alias("n_words")).join(met, same(met), "left").select(
        "doc_id", "text_hash", "n_words", *(F.coalesce(c, e).alias(c) for c, e in nothing.items()))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", **options) -> DataFrame:
    """``docs`` without its contaminated documents, or (``remove="spans"``) with
    the hit words and the separators after them cut out of their texts. All
    columns stay; documents are matched by id (null-safe) and text."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    found = contamination(docs, benchmark, **options).where("n_hit > 0").dropDuplicates(["doc_id", "text_hash"])
    flags = found.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("hit_spans").alias("__spans"))
    same = F.col(f"`{id_col}`").eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(f"`{text_col}`")) == F.col("__hash"))
    if remove == "documents":
        return docs.join(flags, same, "left_anti")
    if remove != "spans":
        raise ValueError(remove)
    text, hit = F.col(f"`{text_col}`"), F.col("__spans").isNotNull()
    # as columns: inside the lambda below the expressions would run once per word
    both = docs.join(flags, same, "left").withColumns({
        "__words": F.when(hit, F.regexp_extract_all(text, F.lit(_WORDS), F.lit(0))), "__between": F.when(hit, F.split(text, _WORDS))})
    rest = F.transform(F.sequence(F.lit(0), F.size("__words") - 1), lambda i: F.when(
        F.exists("__spans", lambda s: (i >= s["s"]) & (i < s["e"])), F.lit("")).otherwise(
        F.concat(F.get("__words", i), F.get("__between", i + 1))))
    cut = F.when(hit, F.concat(F.get("__between", F.lit(0)), F.array_join(rest, ""))).otherwise(text)
    return both.withColumn(text_col, cut).select(*[f"`{c}`" for c in docs.columns])
