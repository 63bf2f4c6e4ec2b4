"""Array helpers over blocks of texts.

The operators read texts as Arrow string columns inside ``mapInArrow`` tasks.
A block is the concatenated UTF-8 bytes of some rows plus row offsets; words,
word hashes and shingles are then computed for all rows of the block at once
with numpy. Memory per task is bounded by ``BLOCK_BYTES`` plus one text.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1


def lean(run):
    """A ``mapInArrow`` function that hands freed memory back to the machine at
    its end. Workers are kept from task to task, and an executor's limit counts
    what they hold on to."""
    def task(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):       # only glibc has it
                ctypes.CDLL(None).malloc_trim(0)

    return task


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES):
    """Yield ``(first_row, bytes, offsets)`` for runs of rows of about ``limit``
    bytes; NULL rows count as empty. ``offsets`` has one more entry than rows."""
    if pa.types.is_string(texts.type):
        texts = texts.cast(pa.large_string())
    n = len(texts)
    if n == 0:
        return
    off = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=n + 1, offset=texts.offset * 8)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    if texts.null_count:                  # a NULL slot may still span bytes
        keep = texts.is_valid().to_numpy(zero_copy_only=False)
        if ((np.diff(off) > 0) & ~keep).any():
            yield from blocks(texts.fill_null(""), limit)
            return
    i = 0
    while i < n:
        j = int(np.searchsorted(off, off[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, raw[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply and xor-shift)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(27))
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=None)
def _byte_codes() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, ``n`` of each."""
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for base in (_BASE, inverse):
        p = np.ones(1, np.uint64)
        while len(p) < n:
            with np.errstate(over="ignore"):
                p = np.concatenate([p, p * np.uint64(pow(base, len(p), 1 << 64))])
        out.append(p[:n])
    return out[0], out[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hashes of the byte spans ``[start, end)``; equal bytes
    give equal hashes wherever they stand."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = 1 << max(12, int(len(data)).bit_length())
    power, inverse = _powers(size)
    with np.errstate(over="ignore"):
        sums = np.empty(len(data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_byte_codes()[data] * power[:len(data)], out=sums[1:])
        h = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(h + np.uint64(0x51ED27))


@functools.lru_cache(maxsize=None)
def lower_ascii() -> np.ndarray:
    """Byte table that maps A-Z to a-z."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


@functools.lru_cache(maxsize=None)
def word_bytes(kind: str) -> np.ndarray:
    """Byte table: True inside a word. ``space``: anything but space and
    tab..carriage return; ``alnum``: a-z, 0-9 and every byte of a non-ASCII character."""
    t = np.zeros(256, bool)
    if kind == "space":
        t[:] = True
        t[[0x20, 9, 10, 11, 12, 13]] = False
    else:
        t[0x30:0x3A] = True
        t[0x61:0x7B] = True
        t[0x80:] = True
    return t


def words(data: np.ndarray, offsets: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, row)`` of all words of a block; words never cross rows."""
    inside = word_bytes(kind)[data]
    if not inside.any():
        z = np.zeros(0, np.int64)
        return z, z, z
    before = np.empty(len(inside), bool)
    before[0] = False
    before[1:] = inside[:-1]
    cut = offsets[:-1][offsets[:-1] < len(data)]
    before[cut] = False                            # a row begins a new word
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(inside), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    last = offsets[1:] - 1
    after[last[last >= 0]] = False
    ends = np.flatnonzero(inside & ~after) + 1
    row = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, row


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``start..start+length`` of every span, one after another."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    at = np.cumsum(lengths) - lengths
    return np.repeat(starts - at, lengths) + np.arange(total)
