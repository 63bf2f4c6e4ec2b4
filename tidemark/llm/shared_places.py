"""Places of the 64-bit keys that more than one document has.

Keys (hashes of seeds or windows) are many and small, so they travel packed: a
task deals its keys to 4096 ranges, one row holds some hundred of them with
their places, and a range is settled by sorting it once. What is found goes
back packed by the hash of its text, one row per text at the end.

A key that a pack holds ``CROWD`` times or more is sent to its range once, as a
summary; its places are dealt anywhere and joined with the key's first place
afterwards, so a very common key is never gathered in one task.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runs import slices
from tidemark.llm.textblocks import lean, mix
from tidemark.session import materialize

CROWD = 64                       # places of one key in a pack from which they do not go to its range
PACK = 1 << 19                   # places that a task packs at once
_RANGE_BITS = 12
_ORDINARY, _SUMMARY, _CROWDED = 0, 1, 2

PLACE = [np.int64, np.int64, np.uint32]             # document, text hash, number of the word
FOUND = [np.uint32, np.int64]                       # place of ``shared_places``, document that keeps the first


def _packed(*columns: np.ndarray) -> bytes:
    """Columns one after another, each byte plane by byte plane: upper planes of
    small numbers compress away."""
    return b"".join(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes() for x in columns)


def _unpacked(raw: list[bytes], kinds: list) -> list[np.ndarray]:
    """The columns of several ``_packed``, each in one."""
    sizes = [np.dtype(k).itemsize for k in kinds]
    parts: list[list] = [[np.zeros((size, 0), np.uint8)] for size in sizes]
    for one in raw:
        n, at = len(one) // sum(sizes), 0
        for part, size in zip(parts, sizes):
            part.append(np.frombuffer(one, np.uint8, n * size, at).reshape(size, n))
            at += n * size
    return [np.ascontiguousarray(np.concatenate(p, axis=1).T).reshape(-1).view(k) for p, k in zip(parts, kinds)]


def _ranges(hashes: np.ndarray) -> list[tuple[int, int, int]]:
    """``(range, from, to)`` of every range among sorted hashes."""
    cut = np.searchsorted(hashes, np.arange(1, 1 << _RANGE_BITS, dtype=np.uint64) << np.uint64(64 - _RANGE_BITS))
    return [(r, i, j) for r, (i, j) in enumerate(zip(np.append(0, cut).tolist(), np.append(cut, len(hashes)).tolist())) if i < j]


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for x in columns:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _groups(batches):
    """The rows of sorted batches, a list of slices for each value of the first column."""
    now, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        of = batch.column(0).to_numpy()
        at = np.append(_starts(of), len(of)).tolist()
        for i, j in zip(at[:-1], at[1:]):
            if held and of[i] != now:
                yield held
                held = []
            now = of[i]
            held.append(batch.slice(i, j - i))
    if held:
        yield held


def _column(held, i: int) -> list:
    return [x for batch in held for x in batch.column(i).to_pylist()]


def _in_packs(parts):
    """Tuples of arrays, gathered to about ``PACK`` entries."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part[0])
        if n >= PACK:
            pack, held, n = [np.concatenate(x) for x in zip(*held)], [], 0
            yield pack
    if n:
        yield [np.concatenate(x) for x in zip(*held)]


DEALT = "r int, kind int, key long, entries binary"


def _deal(key, doc, text, at, salt: int) -> pa.RecordBatch:
    """Rows ``DEALT`` of one pack."""
    order = np.argsort(key)
    key, doc, text, at = key[order], doc[order], text[order], at[order]
    first = _starts(key)
    many = np.diff(np.append(first, len(key)))
    crowded = many >= CROWD
    rows = []
    for i, n in zip(first[crowded].tolist(), many[crowded].tolist()):
        own = slice(i, i + n)
        least = i + np.lexsort((at[own], text[own], doc[own]))[:1]
        r, signed = int(key[i] >> np.uint64(64 - _RANGE_BITS)), int(key[i].astype(np.int64))
        rows.append((r, _SUMMARY, signed, _packed(key[i:i + 1], doc[least], text[least], at[least], doc[own].max(keepdims=True))))
        rows.append((r + salt & (1 << _RANGE_BITS) - 1, _CROWDED, signed, _packed(doc[own], text[own], at[own])))
    rest = np.repeat(~crowded, many)
    key, doc, text, at = key[rest], doc[rest], text[rest], at[rest]
    rows += [(r, _ORDINARY, None, _packed(key[i:j], doc[i:j], text[i:j], at[i:j])) for r, i, j in _ranges(key)]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.binary()))],
                                      names=["r", "kind", "key", "entries"])


def _of_texts(doc, text, place, kept_in) -> tuple[list, list, list]:
    """``d, texts, entries``: what is found in one pack, by ranges of the texts' hashes."""
    h = mix(doc.view(np.uint64) ^ mix(text.view(np.uint64)))
    order = np.argsort(h)
    h, doc, text, place, kept_in = h[order], doc[order], text[order], place[order], kept_in[order]
    d, texts, entries = [], [], []
    for r, i, j in _ranges(h):
        new = _starts(doc[i:j], text[i:j])
        d.append(r)
        texts.append(_packed(doc[i:j][new], text[i:j][new], np.diff(np.append(new, j - i)).astype(np.uint32)))
        entries.append(_packed(place[i:j], kept_in[i:j]))
    return d, texts, entries


def _settle(held):
    """``(key, first document, first text, first word number, found)`` of one
    range; the first four hold the keys of summaries that documents share."""
    kinds, entries = (_column(held, i) for i in (1, 3))
    key, doc, text, at = _unpacked([e for k, e in zip(kinds, entries) if k == _ORDINARY], [np.uint64, *PLACE])
    sums = _unpacked([e for k, e in zip(kinds, entries) if k == _SUMMARY], [np.uint64, *PLACE, np.int64])
    summary = np.append(np.zeros(len(key), bool), np.ones(len(sums[0]), bool))
    last = np.append(doc, sums[4])
    key, doc, text, at = (np.append(x, y) for x, y in zip((key, doc, text, at), sums))
    order = np.argsort(key)
    key, doc, text, at, last, summary = (x[order] for x in (key, doc, text, at, last, summary))
    first = _starts(key)
    many = np.diff(np.append(first, len(key)))
    low = np.minimum.reduceat(doc, first)
    # of the first document's places the one of the least text and word number
    own = np.where(doc == np.repeat(low, many), text, np.iinfo(np.int64).max)
    low_text = np.minimum.reduceat(own, first)
    least = (doc == np.repeat(low, many)) & (text == np.repeat(low_text, many))
    low_at = np.minimum.reduceat(np.where(least, at, np.iinfo(np.uint32).max), first)
    shared = low < np.maximum.reduceat(last, first)
    asked = np.flatnonzero(shared & np.logical_or.reduceat(summary, first))
    keep = np.repeat(shared, many) & ~summary
    kept = least & (at == np.repeat(low_at, many))
    return key[first][asked], low[asked], low_text[asked], low_at[asked], \
        (doc[keep], text[keep], at[keep] << 1 | kept[keep].astype(np.uint32), np.repeat(low, many)[keep])


SETTLED = "kind int, d int, texts binary, key long, kept_in long, kept_text long, kept_at long, entries binary"


def _settled(kind: int, **columns) -> pa.RecordBatch:
    """Rows ``SETTLED`` of one kind; columns that are not given are NULL."""
    n = len(next(iter(columns.values())))
    kinds = {"d": pa.int32(), "texts": pa.binary(), **{c: pa.int64() for c in ("key", "kept_in", "kept_text", "kept_at")}, "entries": pa.binary()}
    arrays = [pa.nulls(n, t) if c not in columns else columns[c] if isinstance(columns[c], pa.Array) else pa.array(columns[c], t) for c, t in kinds.items()]
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), *arrays], names=["kind", *kinds])


def shared_places(docs: DataFrame, keys: Callable, name: str) -> DataFrame:
    """One row per text with a key that another document has as well: ``doc_id,
    text_hash``, ``places`` (unsigned 32-bit: twice the number of the word, and
    1 if it is the key's first place) and ``kept_in`` (signed 64-bit: the document
    of that first place, by document, text hash and word number), both packed
    in the same order.

    ``docs`` begins with ``doc_id`` and ``text_hash``; ``keys`` gives for a batch
    of it ``(rows in the batch, keys, numbers of words)``, block by block."""
    def scan(batches):
        def places():
            for batch in batches:
                if batch.num_rows:
                    ids, texts = (batch.column(i).to_numpy() for i in (0, 1))
                    for row, key, at in keys(batch):
                        yield key, ids[row], texts[row], at.astype(np.uint32)

        salt = 1 + 977 * TaskContext.get().partitionId()
        for turn, pack in enumerate(_in_packs(places())):
            yield _deal(*pack, salt + 389 * turn)

    def settle(batches):
        found, n = [], 0
        for held in _groups(batches):
            *(key, kept_in, kept_text, kept_at), rows = _settle(held)
            if len(key):
                yield _settled(_SUMMARY, key=key.view(np.int64), kept_in=kept_in, kept_text=kept_text, kept_at=kept_at.astype(np.int64))
            here = pa.Table.from_batches(held)
            crowded = here.filter(pc.equal(here.column("kind"), _CROWDED)).combine_chunks()
            if crowded.num_rows:
                yield _settled(_CROWDED, **{c: crowded.column(c).chunk(0) for c in ("key", "entries")})
            found.append(rows)
            n += len(rows[0])
            if n >= PACK:
                yield of_texts(found)
                found, n = [], 0
        if n:
            yield of_texts(found)

    def of_texts(found):
        return _settled(_ORDINARY, **dict(zip(("d", "texts", "entries"), _of_texts(*(np.concatenate(x) for x in zip(*found))))))

    def answer(batches):
        def found():
            for batch in batches:
                for kept_in, kept_text, kept_at, raw in zip(*(c.to_pylist() for c in batch.columns)):
                    doc, text, at = _unpacked([raw], PLACE)
                    kept = (doc == kept_in) & (text == kept_text) & (at == kept_at)
                    yield doc, text, at << 1 | kept.astype(np.uint32), np.full(len(doc), kept_in)

        for pack in _in_packs(found()):
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(_of_texts(*pack), (pa.int32(), pa.binary(), pa.binary()))], names=["d", "texts", "entries"])

    def by_text(batches):
        for held in _groups(batches):
            doc, text, many = _unpacked(_column(held, 1), PLACE)
            place, kept_in = _unpacked(_column(held, 2), FOUND)
            order = np.lexsort((text, doc))
            first = _starts(doc[order], text[order])
            of = np.empty(len(doc), np.int64)
            of[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(doc))))
            owner = np.repeat(of, many)
            turn = np.argsort(owner, kind="stable")
            at = np.append(0, np.cumsum(np.bincount(owner, minlength=len(first))))
            yield pa.RecordBatch.from_arrays([
                pa.array(doc[order][first]), pa.array(text[order][first]), slices(place[turn], at * place.itemsize), slices(kept_in[turn], at * kept_in.itemsize)],
                names=["doc_id", "text_hash", "places", "kept_in"])

    # sorted, so that a task holds one range at a time
    dealt = docs.mapInArrow(lean(scan), DEALT).repartition("r").sortWithinPartitions("r")
    settled = materialize(dealt.mapInArrow(lean(settle), SETTLED), name)
    first = settled.where(f"kind = {_SUMMARY}").select("key", "kept_in", "kept_text", "kept_at").distinct()
    crowded = settled.where(f"kind = {_CROWDED}").select("key", "entries").join(first, "key")
    found = settled.where(f"kind = {_ORDINARY}").select("d", "texts", "entries").unionByName(
        crowded.select("kept_in", "kept_text", "kept_at", "entries").mapInArrow(lean(answer), "d int, texts binary, entries binary"))
    dealt = found.repartition("d").sortWithinPartitions("d")
    return dealt.mapInArrow(lean(by_text), "doc_id long, text_hash long, places binary, kept_in binary")


def unpack(places: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(entries of each row, numbers of words, first places)`` of ``places`` of
    ``shared_places``; NULL rows have none."""
    raw = [x or b"" for x in places.to_pylist()]
    place = np.frombuffer(b"".join(raw), np.uint32)
    return np.array([len(x) // 4 for x in raw], np.int64), (place >> 1).astype(np.int64), (place & 1) > 0


def unpack_ids(ids: pa.Array) -> np.ndarray:
    """``kept_in`` of ``shared_places``, row after row; NULL rows have none."""
    return np.frombuffer(b"".join(x or b"" for x in ids.to_pylist()), np.int64)
