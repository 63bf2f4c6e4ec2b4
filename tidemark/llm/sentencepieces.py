"""SentencePiece encoding and decoding by weighted finite-state transduction.

``compile_model`` turns a model file into the composed parts of one transducer:

* the normaliser: the model's character map as an automaton whose longest match
  is rewritten, escape of white space, dummy prefix, collapse of extra white
  space where the model asks for it (models with user-defined pieces are refused);
* the pieces: an automaton over characters whose final states carry a piece and its weight;
* byte fallback: a character that no piece spells becomes its bytes' pieces, or,
  in models without it, the unknown piece, one for a run of such characters.

Composing it with an input gives a lattice whose states are positions together
with the last piece. Unigram models weigh an arc with its negated score; sums
are rounded as the library rounds them, and of equal paths to a position the
first found stays, by start and then by length, so ties fall the same way. In a
BPE model merges, not sums of scores, decide; there an arc that may not follow
the last piece weighs infinity and every other arc 0. Two pieces may follow
each other if merging their concatenation gives just those two, and a sequence
is the BPE result exactly if all neighbours may follow each other. One finite
path is left, so the tropical shortest path is the library's result.

That argument needs every piece to be made of pieces merged before it. Pieces
for which this fails (``irregular``; in practice runs of white space) are found
when compiling, and a stretch of text that holds one is merged step by step.

Texts of BPE models without a character map are cut between characters that no
piece holds side by side (such as before a space that follows another character,
or around line breaks); the lattice is solved once per distinct stretch and
worker. Other models take texts whole, as rounding and runs go across such
places. NULL and empty texts have no
pieces; repeated rows each get a row.
"""

from __future__ import annotations

import functools
import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tidemark.llm.bpe import MemoEncoder
from tidemark.llm.textblocks import blocks, lean, ragged

SPACE = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MOST_PAIRS = 1_000_000           # neighbour checks remembered per worker
ENCODE_BYTES = 1 << 18           # text encoded at once


class Automaton:
    """Strings as paths from state 0; the last state of each carries a value."""

    def __init__(self, strings=()):
        self.arcs: list[dict[str, int]] = [{}]
        self.value: list = [None]
        for text, value in strings:
            state = 0
            for c in text:
                to = self.arcs[state].get(c)
                if to is None:
                    to = self.arcs[state][c] = len(self.arcs)
                    self.arcs.append({})
                    self.value.append(None)
                state = to
            self.value[state] = value

    def matches(self, text: str, start: int):
        """``(end, value)`` of all strings that stand at ``start``, shorter first."""
        state, end, n = 0, start, len(text)
        while end < n:
            state = self.arcs[state].get(text[end])
            if state is None:
                return
            end += 1
            if self.value[state] is not None:
                yield end, self.value[state]


class CharacterMap:
    """A model's compiled character map as an automaton: a double-array trie of
    the strings to rewrite, and the texts they become, each ended by a zero byte."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units, self.texts = np.frombuffer(blob[4:4 + size], "<u4").tolist(), blob[4 + size:]
        self.steps: dict[tuple[int, str], int | None] = {}

    def _jump(self, at: int) -> int:
        unit = self.units[at]
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def _follow(self, at: int, c: str) -> int | None:
        """The state after a character, or None."""
        for byte in c.encode("utf-8", "replace"):
            at ^= self._jump(at) ^ byte
            if at >= len(self.units) or self.units[at] & 0x800000FF != byte:
                return None
        return at

    def longest(self, text: str, start: int):
        """``(end, rewritten)`` of the longest match at ``start``, or None."""
        at, end, n, found = 0, start, len(text), None
        while end < n:
            key = (at, text[end])
            if key not in self.steps:
                if len(self.steps) >= MOST_PAIRS:
                    self.steps.clear()
                self.steps[key] = self._follow(*key)
            at, end = self.steps[key], end + 1
            if at is None:
                break
            if self.units[at] >> 8 & 1:
                place = self.units[at ^ self._jump(at)] & 0x7FFFFFFF
                found = end, self.texts[place:self.texts.index(b"\0", place)].decode("utf-8", "replace")
        return found


class Transducer:
    """The compiled model."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto
        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, train = model.normalizer_spec, model.trainer_spec
        if train.treat_whitespace_as_suffix or not norm.escape_whitespaces or train.model_type not in (UNIGRAM, BPE) or any(p.type == USER for p in model.pieces):
            raise ValueError("model kind is not supported")
        self.rules = CharacterMap(norm.precompiled_charsmap) if norm.precompiled_charsmap else None
        self.kind, self.prefix, self.collapse = train.model_type, norm.add_dummy_prefix, norm.remove_extra_whitespaces
        self.spelling = [p.piece for p in model.pieces]
        self.score = [p.score for p in model.pieces]
        self.arcs = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        self.bytes = [None] * 256
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                self.bytes[int(p.piece[3:5], 16)] = i
        self.fallback = train.byte_fallback and None not in self.bytes
        self.silent = {i for i, p in enumerate(model.pieces) if p.type in (CONTROL, UNUSED)}
        self.longest = max(map(len, self.arcs))
        weights = [p.score for p in model.pieces if p.type == NORMAL]
        self.unknown_weight = float(np.float32(np.float32(min(weights)) - np.float32(10.0)))
        self.pieces = Automaton([(p, (i, self.score[i])) for p, i in self.arcs.items()] if self.kind == UNIGRAM else ())
        self.whole = self.kind == UNIGRAM or self.rules is not None or self.collapse or not self.fallback
        # where a text may be cut: between two bytes that no piece holds side by side
        self.cut = np.zeros((256, 256), bool)
        pairs = {p[i:i + 2].replace(SPACE, " ") for p in self.arcs for i in range(len(p) - 1)}
        for a in range(128):
            for b in range(128):
                self.cut[a, b] = chr(a) + chr(b) not in pairs
        # a space after any other character, unless that may be an escaped space itself (its last byte is 0x81)
        self.cut[128:, 0x20] = not any(p[1] == " " and p[0] >= "\x80" for p in pairs)
        self.cut[0x81, 0x20] = False
        self.pairs: dict[int, bool] = {}
        if self.kind == BPE:
            self._split_pieces()

    # -- BPE: how each piece is merged -------------------------------------------------
    def merge(self, text: str, last: list | None = None) -> list[str]:
        """Merge step by step: best score first, leftmost among equals."""
        parts, n = list(text), len(text)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list = []

        def offer(i):
            j = after[i] if 0 <= i else n
            if 0 <= i and j < n:
                got = self.arcs.get(parts[i] + parts[j])
                if got is not None:
                    heapq.heappush(heap, (-self.score[got], i, len(parts[i]) + len(parts[j]), got))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, size, got = heapq.heappop(heap)
            j = after[i] if parts[i] else n
            if not parts[i] or j >= n or len(parts[i]) + len(parts[j]) != size or parts[i] + parts[j] != self.spelling[got]:
                continue
            if last is not None:
                last[:] = [parts[i], parts[j]]
            parts[i], parts[j] = parts[i] + parts[j], ""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [p for p in parts if p]

    def _split_pieces(self) -> None:
        """The two halves and the merge rank of each piece; irregular pieces."""
        order = sorted(self.arcs.values(), key=lambda i: (-self.score[i], i))
        self.rank = {}
        for r, i in enumerate(order):
            self.rank[i] = r
        self.left, self.right, self.irregular, unreached = {}, {}, set(), []
        for piece, i in self.arcs.items():
            if len(piece) == 1:
                self.rank[i] = -1                       # characters are there from the start
                continue
            last: list = []
            if self.merge(piece, last) != [piece]:
                unreached.append(piece)
                continue
            self.left[i], self.right[i] = self.arcs.get(last[0]), self.arcs.get(last[1])
        for i in self.left:
            a, b = self.left[i], self.right[i]
            ties = self.score[i]
            if a is None or b is None or not all(len(self.spelling[x]) == 1 or self.score[x] > ties for x in (a, b)):
                self.irregular.add(i)
        if any(len(p) > 1 for p in unreached):
            # a piece that no merge builds never occurs; taken out, it is not an arc
            self.arcs = {p: i for p, i in self.arcs.items() if p not in set(unreached)}
        odd = {self.spelling[i] for i in self.irregular}
        self.odd = [o for o in odd if not any(x != o and x in o for x in odd)]     # the others hold one of these

    def may_follow(self, a: int, b: int) -> bool:
        """True if merging the concatenation of two pieces gives just them."""
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._apart(a, b)
        return known

    def _apart(self, a: int, b: int) -> bool:
        """No merge across the border comes before those inside the two pieces:
        undo inner merges from the latest on, and look at each border pair."""
        rank, spelling, arcs = self.rank, self.spelling, self.arcs
        x, y, till_x, till_y = a, b, float("inf"), float("inf")
        while True:
            across = arcs.get(spelling[x] + spelling[y])
            # x and y stand side by side until one of them is merged on; of
            # equal merges the leftmost comes first: x's own, then across, then y's
            if across is not None and rank[across] < till_x and rank[across] <= till_y:
                return False
            if rank[x] < 0 and rank[y] < 0:
                return True
            if rank[x] > rank[y]:
                till_x, x = rank[x], self.right[x]
            else:
                till_y, y = rank[y], self.left[y]

    # -- shortest path ----------------------------------------------------------------
    def _spell_out(self, c: str) -> list[int]:
        return [self.bytes[b] for b in c.encode("utf-8", "replace")] if self.fallback else [self.unknown]

    def path(self, text: str) -> list[int]:
        """Ids of a stretch of normalised text: the shortest path of its lattice."""
        if self.kind == BPE:
            if self.odd and any(o in text for o in self.odd):
                return [i for p in self.merge(text) for i in ([self.arcs[p]] if p in self.arcs else self._spell_out(p))]
            return self._bpe_path(text)
        return self._unigram_path(text)

    def _bpe_path(self, text: str) -> list[int]:
        arcs, n, longest, may = self.arcs, len(text), self.longest, self.may_follow
        last: list = [None] * (n + 1)                   # the piece by which the finite path reaches a position
        pairs, get = self.pairs, arcs.get
        for e in range(1, n + 1):
            if text[e - 1] not in arcs:
                last[e] = -1                            # fallback: no piece spans it
                continue
            for s in range(e - longest if e > longest else 0, e):
                p = get(text[s:e])
                if p is None:
                    continue
                q = last[s]
                if s == 0 or q == -1:
                    last[e] = p
                    break
                ok = pairs.get(q << 32 | p)
                if may(q, p) if ok is None else ok:
                    last[e] = p
                    break
        out, e = [], n
        while e > 0:
            p = last[e]
            if p == -1:
                out += self._spell_out(text[e - 1])[::-1]
                e -= 1
            else:
                out.append(p)
                e -= len(self.spelling[p])
        return out[::-1]

    def _unigram_path(self, text: str) -> list[int]:
        """The shortest path in (min, +) of the pieces composed with ``text``,
        as the highest sum of scores, which the library keeps in single precision."""
        n, short = len(text), np.float32
        best, back = [0.0] * (n + 1), [None] * (n + 1)
        for s in range(n):
            single, here = False, best[s]
            for e, (p, weight) in self.pieces.matches(text, s):
                total = float(short(weight + here))
                if back[e] is None or total > best[e]:
                    best[e], back[e] = total, (s, p)
                single |= e == s + 1
            if not single:
                total = float(short(self.unknown_weight + here))
                if back[s + 1] is None or total > best[s + 1]:
                    best[s + 1], back[s + 1] = total, (s, -1)
        out, e = [], n
        while e > 0:
            s, p = back[e]
            out += self._spell_out(text[s])[::-1] if p == -1 else [p]
            e = s
        return out[::-1]

    # -- whole texts ------------------------------------------------------------------
    def _rewritten(self, text: str):
        """The character map's output for ``text``, match by match."""
        at, n = 0, len(text)
        while at < n:
            rule = self.rules.longest(text, at)
            yield rule[1] if rule else text[at]
            at = rule[0] if rule else at + 1

    def normalise(self, text: str) -> str:
        if not self.collapse:
            if not text:
                return ""
            text = text if self.rules is None else "".join(self._rewritten(text))
            return ((" " if self.prefix else "") + text).replace(" ", SPACE)
        out, after_space = [], True
        for part in text if self.rules is None else self._rewritten(text):
            if after_space:
                part = part.lstrip(" ")
            if part:
                out.append(part)
                after_space = part.endswith(" ")
        if not out:
            return ""
        return ((" " if self.prefix else "") + "".join(out)).replace(" ", SPACE).rstrip(SPACE)

    def encode(self, text: str) -> list[int]:
        ids = self.path(self.normalise(text))
        if not self.fallback:
            ids = [p for k, p in enumerate(ids) if p != self.unknown or k == 0 or ids[k - 1] != p]
        return ids

    def decode(self, ids) -> str:
        out, head = bytearray(), self.prefix or self.collapse
        for i in ids:
            piece = self.spelling[i]
            if i in self.silent:
                continue
            if self.bytes and piece.startswith("<0x") and i == self.bytes[int(piece[3:5], 16)]:
                out.append(int(piece[3:5], 16))
            elif i == self.unknown:
                out += b" \xe2\x81\x87 "
            else:
                if head and not out and piece.startswith(SPACE):
                    # the dummy prefix; where white space collapses, all that pieces begin with before the first character
                    piece, head = piece[1:], self.collapse
                out += piece.encode("utf-8")
        return out.decode("utf-8", "replace").replace(SPACE, " ")


class LatticeEncoder(MemoEncoder):
    """Block encoder whose stretches are solved by the transducer."""

    head_salt = np.uint64(0x9E3779B97F4A7C15)       # the first stretch of a text has the dummy prefix

    def __init__(self, machine: Transducer, most: int = 800_000):
        self.machine, self.most = machine, most
        self.exact = True
        self._clear()

    def _cut(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(data)
        cut = np.zeros(n, bool)
        if not self.machine.whole:
            cut[1:] = self.machine.cut[data[:-1], data[1:]]
        first = offsets[:-1]
        cut[first[first < n]] = True
        return np.flatnonzero(cut)

    def _learn(self, data, starts, ends, heads):
        m = self.machine
        got = []
        raw = data.tobytes()
        for a, b, head in zip(starts.tolist(), ends.tolist(), heads.tolist()):
            text = raw[a:b].decode("utf-8", "replace")
            got.append(m.encode(text) if head else m.path(text.replace(" ", SPACE)))
        self._store(np.asarray([i for x in got for i in x], np.int32), np.asarray([len(x) for x in got], np.int64))
        return np.arange(len(got))


@functools.lru_cache(maxsize=2)
def compile_model(path: str) -> Transducer:
    return Transducer(path)


@functools.lru_cache(maxsize=2)
def lattice_encoder(path: str) -> LatticeEncoder:
    return LatticeEncoder(compile_model(path))


@functools.lru_cache(maxsize=2)
def _spellings(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 bytes of all pieces one after another (escaped space as a space), their offsets, and which are bytes."""
    m = compile_model(path)
    raw = []
    for i, p in enumerate(m.spelling):
        raw.append(b"" if i in m.silent else bytes([m.bytes.index(i)]) if i in m.bytes else
                   b" \xe2\x81\x87 " if i == m.unknown else p.replace(SPACE, " ").encode("utf-8"))
    is_byte = np.zeros(len(raw), bool)
    is_byte[[i for i in m.bytes if i is not None]] = True
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]), is_byte


def encode(docs: DataFrame, model: str, text_col: str = "text", ids_col: str = "piece_ids") -> DataFrame:
    """All rows and columns of ``docs`` and the piece ids of the text (in place
    of an input column of that name)."""
    docs = docs.drop(ids_col)
    at = docs.columns.index(text_col)

    def run(batches):
        enc = lattice_encoder(model)
        for batch in batches:
            # a row batch per block, so that neither side holds the ids of more than one
            for first, data, offsets in blocks(batch.column(at), ENCODE_BYTES) if batch.num_rows else ():
                ids, n = enc.encode(data, offsets)
                upto = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.slice(first, len(n)).columns, pa.ListArray.from_arrays(pa.array(upto), pa.array(ids))],
                                                 names=[*batch.schema.names, ids_col])

    return docs.mapInArrow(lean(run), StructType([*docs.schema.fields, StructField(ids_col, ArrayType(IntegerType()))]))


def decode(encoded: DataFrame, model: str, ids_col: str = "piece_ids", text_col: str = "decoded") -> DataFrame:
    """All rows and columns and the text that the ids spell (NULL ids: NULL)."""
    encoded = encoded.drop(text_col)
    at = encoded.columns.index(ids_col)

    def run(batches):
        m = compile_model(model)
        flat, offsets, _ = _spellings(model)
        for batch in batches:
            out = []
            for ids in batch.column(at):
                if not ids.is_valid:
                    out.append(None)
                    continue
                i = ids.values.to_numpy(zero_copy_only=False)
                if m.collapse:
                    out.append(m.decode(i.tolist()))
                    continue
                text = flat[ragged(offsets[i], offsets[i + 1] - offsets[i])].tobytes().decode("utf-8", "replace")
                out.append(text[1:] if m.prefix and text.startswith(" ") else text)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, text_col])

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField(text_col, StringType())]))


def round_trip(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_pieces, n_byte_pieces, ids_crc32``
    (little-endian unsigned 32-bit ids) and ``restored``, whether decoding the
    ids gives the normalised text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        enc, m = lattice_encoder(model), compile_model(model)
        flat, at, is_byte = _spellings(model)
        for batch in batches:
            cols: list[list] = [[], [], [], []]
            for _, data, offsets in blocks(batch.column(1)) if batch.num_rows else ():
                ids, n = enc.encode(data, offsets)
                upto = np.concatenate([[0], np.cumsum(n)])
                width = at[ids + 1] - at[ids]
                spelled = flat[ragged(at[ids], width)]
                ends = np.concatenate([[0], np.cumsum(width)])[upto]
                odd = np.concatenate([[0], np.cumsum(is_byte[ids])])[upto]
                raw = ids.astype("<u4")
                for i in range(len(n)):
                    text = data[offsets[i]:offsets[i + 1]].tobytes()
                    if m.collapse or m.rules is not None or SPACE.encode() in text:
                        text = m.normalise(text.decode("utf-8", "replace")).replace(SPACE, " ").encode("utf-8")
                    elif text and m.prefix:
                        text = b" " + text
                    cols[0].append(int(n[i]))
                    cols[1].append(int(odd[i + 1] - odd[i]))
                    cols[2].append(zlib.crc32(raw[upto[i]:upto[i + 1]].tobytes()))
                    cols[3].append(spelled[ends[i]:ends[i + 1]].tobytes() == text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.bool_())],
                names=["doc_id", "n_pieces", "n_byte_pieces", "ids_crc32", "restored"])

    return rows.mapInArrow(lean(run), "doc_id long, n_pieces long, n_byte_pieces long, ids_crc32 long, restored boolean")
