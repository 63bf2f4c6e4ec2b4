"""Byte-level BPE ids of whole texts, memoised at proven cut points.

A byte-level tokenizer without normaliser first cuts a text with a pattern in
which no match holds a non-space character followed by white space. A position
where ASCII white space follows a non-space character is therefore always a
border between matches, whatever stands around it, and the ids of a text are
the ids of its pieces between such positions, one after another. The library
encodes each distinct piece once per worker; repeats come from the memo.
"""

from __future__ import annotations

import functools
import json
import os

import numpy as np
import pandas as pd

from tidemark.llm.textblocks import blocks, ragged, span_hashes

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
os.environ.setdefault("RAYON_NUM_THREADS", "1")

MEMO_PIECES = 600_000            # pieces kept per worker before the memo starts anew
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0D]] = True


@functools.lru_cache(maxsize=4)
def library(path: str):
    """The tokenizers-library object of a file; one per worker."""
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=4)
def cuttable(path: str) -> bool:
    """True if the file is of the kind for which the cut points are proven."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    special = [t["content"] for t in spec.get("added_tokens") or []
               if any(c.isspace() for c in t["content"]) or t.get("lstrip") or t.get("rstrip") or t.get("single_word")]
    return (spec.get("normalizer") is None and spec.get("post_processor") is None and not special
            and spec.get("truncation") is None and spec.get("padding") is None
            and pre.get("type") == "ByteLevel" and bool(pre.get("use_regex")) and not pre.get("add_prefix_space"))


def settled(before2: np.ndarray, before: np.ndarray) -> np.ndarray:
    """True where the two bytes end a character that surely is not white space
    (printable ASCII, or a two-byte character from U+00C0 up)."""
    return ((before > 0x20) & (before < 0x7F)) | ((before >= 0x80) & (before2 >= 0xC3) & (before2 <= 0xDF))


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the pieces of a block: row starts and proven cut points."""
    n = len(data)
    one = np.full(n, 0x20, np.uint8)
    two = np.zeros(n, np.uint8)
    one[1:] = data[:-1]
    two[2:] = data[:-2]
    cut = _SPACE[data] & settled(two, one)
    first = offsets[:-1]
    cut[first[first < n]] = True
    return np.flatnonzero(cut)


class MemoEncoder:
    """Ids of blocks of texts; holds at most ``MEMO_PIECES`` pieces plus one block's."""

    head_salt = np.uint64(0)     # not 0 where the first piece of a row is encoded unlike others

    def __init__(self, path: str, most: int = MEMO_PIECES):
        self.lib, self.exact, self.most = library(path), cuttable(path), most
        vocab = self.lib.get_vocab(with_added_tokens=True)
        added = {t.content for t in self.lib.get_added_tokens_decoder().values()}
        self.width = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.width[i] = len(token.encode("utf-8")) if token in added else len(token)
        self._clear()

    def _clear(self):
        self.at, self.used = {}, 0
        self.ids, self.start = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64)
        self.start[0], self.pieces = 0, 0

    def _store(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        need = self.used + len(ids)
        if need > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(need, len(self.ids)), np.int32)])
        self.ids[self.used:need] = ids
        if self.pieces + len(lengths) + 1 > len(self.start):
            self.start = np.concatenate([self.start, np.zeros(max(len(lengths) + 1, len(self.start)), np.int64)])
        self.start[self.pieces + 1:self.pieces + 1 + len(lengths)] = self.used + np.cumsum(lengths)
        self.pieces += len(lengths)
        self.used = need

    def _cut(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return piece_starts(data, offsets)

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """Encode new pieces and give the order in which they were stored
        (``heads``: the piece begins a row). Pieces that begin with white space after settled
        characters go to the library as one text, cut again by token widths."""
        last2 = np.where(ends - starts > 1, data[np.maximum(ends - 2, 0)], 0)
        joined = _SPACE[data[starts]] & settled(last2, data[ends - 1])
        width = ends - starts
        order = np.concatenate([np.flatnonzero(joined), np.flatnonzero(~joined)])
        k = int(joined.sum())
        if k:
            take = order[:k]
            text = data[ragged(starts[take], width[take])].tobytes().decode("utf-8", "replace")
            ids = np.asarray(self.lib.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
            cuts = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum(width[take]), side="left") + 1
            self._store(ids, np.diff(cuts, prepend=0))
        if k < len(order):
            got = self.lib.encode_batch_fast(
                [data[starts[i]:ends[i]].tobytes().decode("utf-8", "replace") for i in order[k:]], add_special_tokens=False)
            got = [x.ids for x in got]
            self._store(np.asarray([i for x in got for i in x], np.int32), np.asarray([len(x) for x in got], np.int64))
        return order

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, n)``: all ids of the rows one after another, and their number per row."""
        rows = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(rows, np.int64)
        if not self.exact:
            texts = [data[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace") for i in range(rows)]
            got = [x.ids for x in self.lib.encode_batch_fast(texts, add_special_tokens=False)]
            return np.asarray([i for x in got for i in x], np.int32), np.asarray([len(x) for x in got], np.int64)
        if self.pieces > self.most:
            self._clear()
        starts = self._cut(data, offsets)
        ends = np.append(starts[1:], len(data))
        heads = np.zeros(len(starts), bool)
        first = np.searchsorted(starts, offsets[:-1][np.diff(offsets) > 0])
        heads[first] = True
        codes, unique = pd.factorize(span_hashes(data, starts, ends) + heads.astype(np.uint64) * self.head_salt)
        get = self.at.get
        keys = unique.tolist()
        slot = np.fromiter((get(h, -1) for h in keys), np.int64, len(keys))
        new = np.flatnonzero(slot < 0)
        if len(new):
            first = np.empty(len(unique), np.int64)
            first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)     # first occurrence of each
            base, pick = self.pieces, first[new]
            new = new[self._learn(data, starts[pick], ends[pick], heads[pick])]
            slot[new] = base + np.arange(len(new))
            self.at.update(zip((keys[i] for i in new.tolist()), range(base, base + len(new))))
        piece = slot[codes]
        lengths = self.start[piece + 1] - self.start[piece]
        ids = self.ids[ragged(self.start[piece], lengths)]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        edge = upto[np.searchsorted(starts, offsets)]
        return ids, np.diff(edge)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> MemoEncoder:
    return MemoEncoder(path)


def encoded_rows(texts, path: str):
    """Yield ``(first_row, ids, n)`` for the blocks of an Arrow string column."""
    enc = encoder(path)
    for first, data, offsets in blocks(texts):
        ids, n = enc.encode(data, offsets)
        yield first, ids, n
