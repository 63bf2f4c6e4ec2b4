"""Token ids in directly addressable codes (DACs).

Ids are cut into byte-wide chunks, low chunk first. Level 0 holds the low chunk
of every id; a continuation bitmap marks ids with more chunks, and those stand,
in order, in the next level. A rank directory (ones before every 512 bits)
turns a position of one level into its position in the next, so any token is
read with one step per level and no block is decoded.

Store layout: a Parquet table without compression, one row per segment of
about ``SEGMENT_TOKENS`` tokens (whole documents, ascending by document id):
``part, seq`` (order of the segments), ``first`` (token position inside the
part), ``n_tokens``, ``doc_ids``, ``doc_tokens`` and ``payload``:

    magic "DAC1" | u32 levels | u64 ids | per level: u64 codes, u64 bitmap words, u64 directory entries
    then per level: codes (u8) padded to 8 bytes | bitmap (u64 words) | directory (u64)

Spark's committed writer makes the files, so a lost task leaves no partial one.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import encoded_rows

SEGMENT_TOKENS = 1 << 18
RANK_BITS = 512
_MAGIC = b"DAC1"


def pack(ids: np.ndarray) -> bytes:
    """The DAC payload of non-negative ids."""
    left = np.asarray(ids, np.uint64)
    heads, bodies, n = [], [], len(left)
    while True:
        codes = (left & np.uint64(0xFF)).astype(np.uint8)
        left = left >> np.uint64(8)
        more = left > 0
        words = -(-len(codes) // RANK_BITS) * (RANK_BITS // 64)
        bits = np.zeros(words * 64, np.uint8)
        bits[:len(codes)] = more
        bitmap = np.packbits(bits, bitorder="little").view(np.uint64)
        ones = bits.reshape(-1, RANK_BITS).sum(axis=1, dtype=np.uint64) if words else np.zeros(0, np.uint64)
        directory = np.concatenate([[np.uint64(0)], np.cumsum(ones, dtype=np.uint64)]).astype(np.uint64)
        heads.append(struct.pack("<QQQ", len(codes), words, len(directory)))
        bodies.append(codes.tobytes() + bytes(-len(codes) % 8) + bitmap.tobytes() + directory.tobytes())
        left = left[more]
        if not len(left):
            break
    return _MAGIC + struct.pack("<IQ", len(heads), n) + b"".join(heads) + b"".join(bodies)


class Reader:
    """Random access into one payload."""

    def __init__(self, payload: bytes):
        if payload[:4] != _MAGIC:
            raise ValueError("not a token segment")
        levels, self.n = struct.unpack_from("<IQ", payload, 4)
        heads = [struct.unpack_from("<QQQ", payload, 16 + 24 * i) for i in range(levels)]
        at, self.levels = 16 + 24 * levels, []
        for codes, words, entries in heads:
            c = np.frombuffer(payload, np.uint8, codes, at)
            at += codes + -codes % 8
            b = np.frombuffer(payload, np.uint8, words * 8, at)
            at += words * 8
            d = np.frombuffer(payload, np.uint64, entries, at)
            at += entries * 8
            self.levels.append((c, b, d))

    def _rank(self, level: int, i: int) -> int:
        _, bitmap, directory = self.levels[level]
        block = i // RANK_BITS
        got = int(directory[block])
        from_byte, to_byte = block * RANK_BITS // 8, i // 8
        if to_byte > from_byte:
            got += int(np.bitwise_count(bitmap[from_byte:to_byte]).sum())
        if i % 8:
            got += (int(bitmap[to_byte]) & ((1 << (i % 8)) - 1)).bit_count()
        return got

    def token(self, i: int) -> int:
        """The id at position ``i``, one step per level."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for k, (codes, bitmap, _) in enumerate(self.levels):
            out |= int(codes[i]) << (8 * k)
            if not (bitmap[i // 8] >> (i % 8)) & 1:
                break
            i = self._rank(k, i)
        return out

    def tokens(self, lo: int, hi: int) -> np.ndarray:
        """The ids ``[lo, hi)``; each level's part of them is one stretch."""
        out, at = np.zeros(hi - lo, np.uint32), np.arange(hi - lo)
        for k, (codes, bitmap, _) in enumerate(self.levels):
            if hi <= lo:
                break
            out[at] |= codes[lo:hi].astype(np.uint32) << np.uint32(8 * k)
            bits = np.unpackbits(bitmap[lo // 8:-(-hi // 8)], bitorder="little")[lo % 8:lo % 8 + hi - lo]
            at = at[bits.astype(bool)]
            lo = self._rank(k, lo)
            hi = lo + len(at)
        return out


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = None,
                id_col: str = "doc_id", text_col: str = "text", segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Encode every whole text (NULL: empty) and write the store to ``path`` in
    ascending order of document id (NULL ids first; equal ids by text).
    ``end_id`` is appended to each document. Other columns are not read."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # the text's hash in the range key splits an id that very many rows share
    rows = rows.withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")

    def segments(batches):
        part, seq, first = TaskContext.get().partitionId(), 0, 0
        doc_ids, sizes, ids, held = [], [], [], 0

        def flush():
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                "first": pa.array([first], pa.int64()), "n_tokens": pa.array([len(flat)], pa.int64()),
                "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())), "doc_tokens": pa.array([sizes], pa.list_(pa.int64())),
                "payload": pa.array([pack(flat)], pa.binary())})

        for batch in batches:
            names = batch.column(0).to_pylist()
            for row, flat, n in encoded_rows(batch.column(1), tokenizer):
                if end_id is not None:
                    flat = np.insert(flat, np.cumsum(n), end_id)
                    n = n + 1
                upto = np.concatenate([[0], np.cumsum(n)])
                lo = 0
                while lo < len(n):                          # cut the block into segments of whole documents
                    hi = int(np.searchsorted(upto, upto[lo] + segment_tokens - held, side="left"))
                    hi = min(max(hi, lo + 1), len(n))
                    doc_ids += names[row + lo:row + hi]
                    sizes += n[lo:hi].tolist()
                    ids.append(flat[upto[lo]:upto[hi]])
                    held += int(upto[hi] - upto[lo])
                    lo = hi
                    if held >= segment_tokens:
                        yield flush()
                        seq, first = seq + 1, first + held
                        doc_ids, sizes, ids, held = [], [], [], 0
        if doc_ids:
            yield flush()

    out = rows.select("doc_id", "text").mapInArrow(
        segments, "part int, seq int, first long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, payload binary")
    out.write.option("compression", "none").mode("overwrite").parquet(path)


def _positions(spark: SparkSession, path: str) -> DataFrame:
    """Segments with their global first token. One total per writing task is
    summed up; the payload column is not read for that."""
    segs = spark.read.parquet(path)
    totals = segs.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = totals.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    # bounded: as many rows as the store has writing tasks
    return segs.join(F.broadcast(parts), "part").withColumn("start", F.col("base") + F.col("first"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per stored document: ``doc_id, start, n_tokens, ids_crc32``
    (crc32 of the ids as little-endian unsigned 32-bit integers)."""
    def decode(batches):
        for batch in batches:
            for doc_ids, sizes, payload, start in zip(*(batch.column(i).to_pylist() for i in range(4))):
                reader = Reader(payload)
                upto = np.concatenate([[0], np.cumsum(np.asarray(sizes, np.int64))])
                crc = [zlib.crc32(reader.tokens(int(a), int(b)).astype("<u4").tobytes()) for a, b in zip(upto, upto[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(start + upto[:-1]), pa.array(sizes, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    segs = _positions(spark, path).select("doc_ids", "doc_tokens", "payload", "start")
    return segs.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokens_at(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """The ids at global token ``position``s (one long column): ``position,
    token``. Each segment serves the positions that fall into it by direct
    addressing; positions outside the store give no row."""
    width = F.lit(SEGMENT_TOKENS)
    segs = _positions(spark, path).where("n_tokens > 0").withColumn("end", F.col("start") + F.col("n_tokens"))
    # equi-join on fixed-width slots of the position axis: no nested loop
    slots = segs.withColumn("slot", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("end") - 1) / width))))
    asked = positions.select(F.col(positions.columns[0]).cast("long").alias("position")).withColumn("slot", F.floor(F.col("position") / width))
    hit = asked.join(slots.select("slot", "start", "end", "payload"), "slot").where("position >= start AND position < end")

    def access(batches):
        last, reader = None, None
        for batch in batches:
            where, start, payload = (batch.column(i).to_pylist() for i in range(3))
            got = []
            for w, s, p in zip(where, start, payload):
                if p is not last:
                    last, reader = p, Reader(p)
                got.append(reader.token(w - s))
            yield pa.RecordBatch.from_arrays([pa.array(where, pa.int64()), pa.array(got, pa.int64())], names=["position", "token"])

    return hit.select("position", "start", "payload").mapInArrow(access, "position long, token long")
