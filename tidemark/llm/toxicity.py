"""Toxicity by a linear classifier over character n-grams scaled by naive
Bayes log-count ratios.

Features are the hashed byte n-grams (``NGRAMS``) of the ASCII-lower-cased
text, present or absent. ``fit`` takes a bounded sample of labelled documents
(``MAX_TOXIC`` and ``MAX_CLEAN`` rows, lowest hash of the id first; of an id in
several rows the text of least hash), counts each
feature's documents per class, and keeps those whose smoothed log-count ratio
``r`` stands out from its sampling error. A logistic regression is then trained
on the features scaled by ``r``; its intercept is moved from the sample's class
shares to those of all training labels. Scoring reads whole texts.

NULL and empty texts have no features and get the intercept's score; labels
that are NULL or not 0/1 are left out, a document with several labels takes the
largest; without labels of both classes every score is the share of label 1
(0 without any). Only texts and labels are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.llm.textblocks import blocks, lean, lower_ascii
from tidemark.session import materialize

NGRAMS = (3, 4, 5, 6, 7)
HASH_BITS = 20
MAX_TOXIC = 4_000                # bound of the training sample, rows of label 1
MAX_CLEAN = 8_000                # and of label 0
MAX_FEATURES = 8_000             # features kept, largest |z| first
LEAST_Z = 3.0                    # |r| in standard errors
STEPS = 200
RIDGE = 1.0
FIT_BLOCK = 1 << 18              # bytes of text whose n-grams are held at once when all of them are counted


@dataclass
class Model:
    """``weights`` by hashed feature (already times ``r``) and the intercept."""
    weights: np.ndarray
    intercept: float


def features(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``(row, feature)`` of all distinct n-grams of the rows; with ``wanted``
    (a Boolean table) only those."""
    low = lower_ascii()[data].astype(np.uint32)
    out = []
    h = np.zeros(len(low), np.uint32)
    longest = max(NGRAMS)
    with np.errstate(over="ignore"):
        for n in range(1, longest + 1):
            if len(low) < n:
                break
            h = h[:len(low) - n + 1] * np.uint32(0x01000193) + low[n - 1:] + np.uint32(1)
            if n not in NGRAMS:
                continue
            f = ((h ^ (h >> np.uint32(15))) * np.uint32(0x9E3779B1 + 2 * n)) >> np.uint32(32 - HASH_BITS)
            at = np.flatnonzero(wanted[f]) if wanted is not None else np.arange(len(f))
            row = np.searchsorted(offsets, at, side="right") - 1
            keep = at + n <= offsets[row + 1]
            out.append((row[keep].astype(np.int64) << HASH_BITS) | f[at[keep]])
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.unique(np.concatenate(out))
    return pairs >> HASH_BITS, pairs & ((1 << HASH_BITS) - 1)


def _labelled_sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, int, int]:
    """The training sample with texts, and the numbers of all labels 0 and 1."""
    clean = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in clean.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = clean.where("toxic = 1").orderBy(*order).limit(MAX_TOXIC).unionAll(
        clean.where("toxic = 0").orderBy(*order).limit(MAX_CLEAN))
    # bounded: MAX_TOXIC + MAX_CLEAN rows of two numbers
    rows = docs.join(F.broadcast(picked), "doc_id")
    # one row per id, so the bound is one of rows; equal texts hash alike, so ties do not matter
    return rows.groupBy("doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"), F.first("toxic").alias("toxic")), n.get(0, 0), n.get(1, 0)


def _train(row: np.ndarray, col: np.ndarray, value: np.ndarray, y: np.ndarray, n_features: int) -> tuple[np.ndarray, float]:
    """Logistic regression with an L2 penalty by Adam on sparse triplets."""
    w, b = np.zeros(n_features), float(np.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9)))
    m, v, rate, p = np.zeros(n_features + 1), np.zeros(n_features + 1), 0.05, len(y)
    for t in range(1, STEPS + 1):
        z = np.bincount(row, weights=w[col] * value, minlength=p) + b
        err = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y
        g = np.append(np.bincount(col, weights=err[row] * value, minlength=n_features) + RIDGE * w * 0.1, err.sum()) / p
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, b


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """``docs``: doc_id, text; ``labels``: doc_id, toxic. Pass only the labels
    that may be learned from."""
    spark = docs.sparkSession
    size = 1 << HASH_BITS
    sample, n0, n1 = _labelled_sample(docs.select("doc_id", "text"), labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")))
    if not n0 or not n1:
        share = n1 / (n0 + n1) if n0 + n1 else 0.0
        return Model(np.zeros(size, np.float32), 40.0 if share else -40.0)
    sample = materialize(sample.select("text", "toxic"), "toxicity-sample")

    def count(batches):
        by_class, docs_of = np.zeros((2, size), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            y = batch.column(1).to_numpy(zero_copy_only=False)
            docs_of += np.bincount(y, minlength=2)
            for first, data, offsets in blocks(batch.column(0), FIT_BLOCK):
                row, f = features(data, offsets)
                for k in (0, 1):
                    by_class[k] += np.bincount(f[y[first + row] == k], minlength=size)
        seen = np.flatnonzero(by_class.sum(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(seen, -1)), *(pa.array(np.append(by_class[k][seen], docs_of[k])) for k in (0, 1))], names=["f", "n0", "n1"])

    sums = sample.mapInArrow(lean(count), "f long, n0 long, n1 long").groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    sums = materialize(sums, "toxicity-counts")
    d0, d1 = sums.where("f = -1").select("n0", "n1").first() or (0, 0)
    if not d0 or not d1:
        return Model(np.zeros(size, np.float32), float(np.log(n1 / n0)))
    p1, p0 = (F.col("n1") + 1) / F.lit(d1 + 2.0), (F.col("n0") + 1) / F.lit(d0 + 2.0)
    ratio = F.log(p1 / (1 - p1)) - F.log(p0 / (1 - p0))
    error = F.sqrt(1 / (F.col("n1") + 1) + 1 / (d1 + 1.0 - F.col("n1")) + 1 / (F.col("n0") + 1) + 1 / (d0 + 1.0 - F.col("n0")))
    # bounded: MAX_FEATURES rows
    kept = (sums.where("f >= 0").select("f", F.log(p1 / p0).alias("r"), (ratio / error).alias("z")).where(F.abs("z") >= LEAST_Z)
            .orderBy(F.abs("z").desc(), "f").limit(MAX_FEATURES).collect())
    prior = float(np.log(n1 / n0))
    if not kept:
        return Model(np.zeros(size, np.float32), prior)
    ids = np.array([k["f"] for k in kept])
    r = np.array([k["r"] for k in kept])
    number = np.full(size, -1, np.int32)
    number[ids] = np.arange(len(ids))
    shared = spark.sparkContext.broadcast(number)

    def select(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            y = batch.column(1).to_numpy(zero_copy_only=False)
            for first, data, offsets in blocks(batch.column(0)):
                row, f = features(data, offsets, shared.value >= 0)
                own = np.searchsorted(row, np.arange(len(offsets)))
                col = shared.value[f].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(y[first:first + len(offsets) - 1].astype(np.int32)),
                     pa.array([col[a:b].tobytes() for a, b in zip(own, own[1:])], pa.binary())], names=["y", "cols"])

    # bounded: the sample's rows with at most MAX_FEATURES numbers each
    rows = sample.mapInArrow(lean(select), "y int, cols binary").toArrow()
    shared.unpersist()
    y = rows["y"].to_numpy().astype(float)
    cols = [np.frombuffer(b.as_py(), np.int32) for b in rows["cols"]]
    row = np.repeat(np.arange(len(y)), [len(c) for c in cols])
    col = np.concatenate(cols) if len(cols) else np.zeros(0, np.int32)
    w, b = _train(row, col, r[col], y, len(ids))
    weights = np.zeros(size, np.float32)
    weights[ids] = w * r
    return Model(weights, b + prior - float(np.log(d1 / d0)))


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` and the score, 0 to 1 (in place of an
    input column of that name)."""
    docs = docs.drop(score_col)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.intercept))
    at = docs.columns.index(text_col)

    def run(batches):
        weights, intercept = shared.value
        wanted = weights != 0
        for batch in batches:
            z = np.full(batch.num_rows, intercept)
            for first, data, offsets in blocks(batch.column(at)) if batch.num_rows else ():
                row, f = features(data, offsets, wanted)
                z[first:first + len(offsets) - 1] += np.bincount(row, weights=weights[f], minlength=len(offsets) - 1)
            p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], names=[*batch.schema.names, score_col])

    return docs.mapInArrow(lean(run), StructType([*docs.schema.fields, StructField(score_col, DoubleType())]))
