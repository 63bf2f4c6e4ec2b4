"""Token counts by overlap resynchronisation.

A huge document is encoded as overlapping chunks with offsets. Two neighbour
chunks are spliced at a position inside their overlap which begins a token in
both encodings and is a proven stable border (white space after a non-space
character: no match of the tokenizer's pattern spans it, see ``bpe``). Without
such a position the overlap is doubled, up to the whole rest of the document.
Smaller documents are encoded whole.

NULL texts count as empty; repeated rows are counted each; an empty table
gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import cuttable, encoder, library
from tidemark.llm.textblocks import blocks

HUGE_BYTES = 1 << 16             # documents above this are cut into chunks
CHUNK_CHARS = 1 << 15
OVERLAP_CHARS = 1 << 9


def stable_borders(text: str, lo: int, hi: int) -> list[int]:
    """Positions of ``(lo, hi)`` where ASCII white space follows a non-space character."""
    return [p for p in range(lo + 1, hi) if text[p] in " \n\t\r" and not text[p - 1].isspace()]


def splice_ids(text: str, lib, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> tuple[list[int], int]:
    """``(ids, widened)``: the ids of ``text`` from its overlapping chunks, and
    how often an overlap had to be widened."""
    def ids_from(lo, hi):
        e = lib.encode(text[lo:hi], add_special_tokens=False)
        return e.ids, [lo + s for s, _ in e.offsets]

    out: list[int] = []
    widened, hi = 0, min(chunk, len(text))
    ids, begins = ids_from(0, hi)
    keep = 0                                    # first id of the chunk that is not yet out
    while hi < len(text):
        wide = overlap
        while True:
            lo = max(hi - wide, 0)
            nxt = min(lo + chunk + wide, len(text))
            more, more_begins = ids_from(lo, nxt)
            floor = begins[keep] if keep < len(begins) else hi
            both = set(begins[keep:]) & set(more_begins)
            border = [p for p in stable_borders(text, lo, hi) if p in both and p > floor]
            if border or lo == 0:
                break
            wide, widened = wide * 2, widened + 1
        if border:
            p = border[len(border) // 2]
            out += ids[keep:begins.index(p, keep)]
            ids, begins, keep = more, more_begins, more_begins.index(p)
        else:                                   # no border at all so far: the new chunk starts at 0
            ids, begins, keep = more, more_begins, 0
            out = []
        hi = nxt
    return out + ids[keep:], widened


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text",
                 huge_bytes: int = HUGE_BYTES, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """One row per document: id, ``n_bytes``, ``n_tokens``, ``over_limit`` and
    ``n_chunks_widened``. ``tokenizer`` is a tokenizers-library file; where its
    kind has no proven border, every text is encoded whole."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def count(batches):
        enc = encoder(tokenizer)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            if len(ids) == 0:
                continue
            n_bytes, n_tokens, widened = (np.zeros(len(ids), np.int64) for _ in range(3))
            for first, data, offsets in blocks(texts):
                size = np.diff(offsets)
                n_bytes[first:first + len(size)] = size
                big = np.flatnonzero(size > huge_bytes) if cuttable(tokenizer) else np.zeros(0, np.int64)
                if not len(big):
                    n_tokens[first:first + len(size)] = enc.encode(data, offsets)[1]
                    continue
                for i in big:
                    text = data[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace")
                    got, wide = splice_ids(text, library(tokenizer), chunk, overlap)
                    n_tokens[first + i], widened[first + i] = len(got), wide
                rest = size.copy()
                rest[big] = 0
                small = data[np.repeat(size <= huge_bytes, size)]
                upto = np.concatenate([[0], np.cumsum(rest)])
                n_tokens[first:first + len(size)] += enc.encode(small, upto)[1]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n_bytes), pa.array(n_tokens), pa.array(n_tokens > limit), pa.array(widened)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "n_chunks_widened"])

    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, n_chunks_widened long")
