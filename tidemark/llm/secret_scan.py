"""Secret scans over a trigram inverted index.

Each rule's regex is turned into a Boolean query over trigrams that any match
must hold (an AND of ORs of trigram sets, over ASCII-lower-cased text). Texts
are indexed segment by segment: a segment's postings list, per trigram that
some rule asks for, the rows that hold it. Intersecting and uniting postings
gives each rule's candidate rows, and only those are searched with the regex.
A rule without mandatory trigrams searches every row.

A segment is a block of about a megabyte of texts, so the index never leaves
its task, a lost executor only repeats its own segments, and no source or word
can grow into one large posting list. NULL and empty texts have no spans;
repeated rows each get a result; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import re._parser as sre
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.textblocks import blocks, lean, lower_ascii


@dataclass(frozen=True)
class Rule:
    """A kind of secret: spans of ``pattern`` whose ``group`` has ``least`` characters."""
    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    base: bool = field(default=True, compare=False)


# fixed values: the kinds of secrets
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]+", 32),
    Rule("private_key", r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----", base=False),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", base=False),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", base=False),
)

_MOST = 64                       # strings an exact set may hold before it is cut


def _follow(nodes, clauses: list) -> set | None:
    """All strings that the node sequence may match, or None if unbounded.
    Sets of which one member must occur are added to ``clauses``."""
    so_far: set | None = {""}

    def cut():
        nonlocal so_far
        if so_far:
            clauses.append(frozenset(so_far))
        so_far = {""}

    bounded = True
    for op, arg in nodes:
        got: set | None = None
        name = str(op)
        if name == "LITERAL":
            got = {chr(arg).lower()}
        elif name == "IN" and all(str(o) == "LITERAL" for o, _ in arg):
            got = {chr(a).lower() for _, a in arg}
        elif name == "AT":
            got = {""}
        elif name == "SUBPATTERN":
            inner: list = []
            got = _follow(arg[-1], inner)
            if got is None:
                clauses.extend(inner)
        elif name == "BRANCH":
            parts, either = [], set()
            for b in arg[1]:
                inner = []
                parts.append(_follow(b, inner))
                if parts[-1] is None:
                    long = [c for c in inner if min(map(len, c)) >= 3]
                    either = either | max(long, key=lambda c: min(map(len, c))) if long and either is not None else None
                elif either is not None:
                    either = either | parts[-1]
            if all(p is not None for p in parts):
                got = set().union(*parts)
            elif either:
                clauses.append(frozenset(either))
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            lo, hi, body = arg
            inner = []
            one = _follow(body, inner)
            if one is not None and (lo, hi) == (0, 1):
                got = one | {""}
            elif one is not None and lo == hi == 1:
                got = one
            elif lo >= 1:                       # at least once: what leads up to it may be joined
                if one is not None and so_far is not None and len(so_far) * len(one) <= _MOST:
                    so_far = {a + b for a in so_far for b in one}
                clauses.extend(inner)
        if got is None or len(got) * len(so_far) > _MOST:
            cut()
            bounded = False
            if got is not None and len(got) <= _MOST:
                so_far = set(got)
            continue
        so_far = {a + b for a in so_far for b in got}
    if bounded:
        return so_far
    cut()
    return None


def trigram_query(pattern: str) -> tuple[tuple[frozenset, ...], ...] | None:
    """``((set, set, ...), ...)``: in every clause, all trigrams (lower-cased,
    UTF-8) of one of its sets occur in any text that matches. None: no clause."""
    clauses: list = []
    exact = _follow(sre.parse(pattern), clauses)
    if exact is not None:
        clauses.append(frozenset(exact))
    out = []
    for c in clauses:
        raw = [s.encode("utf-8") for s in c]
        if not raw or min(map(len, raw)) < 3:
            continue
        sets = {frozenset(b[i:i + 3] for i in range(len(b) - 2)) for b in raw}
        out.append(tuple(sorted((s for s in sets if not any(t < s for t in sets)), key=sorted)))
    return tuple(out) or None


@lru_cache(maxsize=8)
def _compiled(rules: tuple[Rule, ...]):
    queries = [trigram_query(r.pattern) for r in rules]
    names = sorted({t for q in queries if q for clause in q for s in clause for t in s})
    if len(names) > 60_000:
        raise ValueError("too many trigrams")
    number = np.zeros(1 << 24, np.uint16)
    for i, t in enumerate(names):
        number[t[0] << 16 | t[1] << 8 | t[2]] = i + 1
    # a run shorter than the least length fails whole, so a lone repeat is searched with its least length
    searched = [re.sub(r"^(\[[^\]]+\])\+$", rf"\1{{{r.least},}}", r.pattern) if r.least and not r.group else r.pattern for r in rules]
    return queries, {t: i + 1 for i, t in enumerate(names)}, number, [re.compile(p, re.ASCII) for p in searched]


def postings(data: np.ndarray, offsets: np.ndarray, number: np.ndarray) -> dict[int, np.ndarray]:
    """Trigram number -> ascending rows of the segment that hold it."""
    if len(data) < 3:
        return {}
    low = lower_ascii()[data].astype(np.int32)
    found = number[(low[:-2] << 16) | (low[1:-1] << 8) | low[2:]]
    at = np.flatnonzero(found)
    row = np.searchsorted(offsets, at, side="right") - 1
    inside = at + 3 <= offsets[row + 1]                      # no trigram across two rows
    pairs = np.unique(found[at[inside]].astype(np.int64) * len(offsets) + row[inside])
    which, rows = pairs // len(offsets), pairs % len(offsets)
    cut = np.flatnonzero(np.diff(which, prepend=-1))
    return {int(which[a]): rows[a:b] for a, b in zip(cut, np.append(cut[1:], len(which)))}


def candidates(query, lists: dict[int, np.ndarray], number_of: dict, rows: int) -> np.ndarray:
    """Rows that satisfy a Boolean trigram query (None: all rows)."""
    if query is None:
        return np.arange(rows)
    none = np.zeros(0, np.int64)
    out = None
    for clause in query:
        some = none
        for s in clause:
            got = None
            for mine in sorted((lists.get(number_of[t], none) for t in s), key=len):
                got = mine if got is None else np.intersect1d(got, mine, assume_unique=True)
                if not len(got):
                    break
            some = np.union1d(some, got)
        out = some if out is None else np.intersect1d(out, some, assume_unique=True)
    return out


def find_spans(texts: pa.Array, rules: tuple[Rule, ...] = RULES) -> dict[int, list[tuple[int, int, str]]]:
    """Row -> spans ``(start, kind number, end)`` in code points, ordered by start, then by rule."""
    queries, number_of, number, regexes = _compiled(rules)
    out: dict[int, list] = {}
    for first, data, offsets in blocks(texts):
        lists = postings(data, offsets, number)
        known: dict[int, str] = {}
        for k, (rule, query, regex) in enumerate(zip(rules, queries, regexes)):
            for i in candidates(query, lists, number_of, len(offsets) - 1).tolist():
                if i not in known:
                    known[i] = data[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace")
                for m in regex.finditer(known[i]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        out.setdefault(first + i, []).append((m.start(), k, m.end()))
    for spans in out.values():
        spans.sort()
    return out


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id`` and ``spans``, an array of ``(kind,
    start, end)`` by start, then rule order; end exclusive, code points."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def scan(batches):
        for batch in batches:
            found = find_spans(batch.column(1), rules) if batch.num_rows else {}
            spans = [[{"kind": rules[k].kind, "start": s, "end": e} for s, k, e in found.get(i, ())] for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(_SPAN))], names=["doc_id", "spans"])

    return rows.mapInArrow(lean(scan), "doc_id long, spans array<struct<kind:string,start:int,end:int>>")


def redact_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text",
                   length_col: str | None = None, mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns of ``docs``; every span is replaced by ``mark``
    (overlapping spans by one). ``length_col``, if given, is set to the new
    number of code points of changed texts. NULL texts stay NULL."""
    schema = docs.schema
    at = schema.fieldNames().index(text_col)
    size = schema.fieldNames().index(length_col) if length_col else None

    def redact(batches):
        for batch in batches:
            found = find_spans(batch.column(at), rules) if batch.num_rows else {}
            if not found:
                yield batch
                continue
            texts = batch.column(at).to_pylist()
            sizes = batch.column(size).to_pylist() if size is not None else None
            for i, spans in found.items():
                text, done, parts = texts[i], 0, []
                for s, _, e in spans:
                    if s >= done:
                        parts += [text[done:s], mark]
                    done = max(done, e)
                texts[i] = "".join(parts) + text[done:]
                if sizes is not None:
                    sizes[i] = len(texts[i])
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if sizes is not None:
                columns[size] = pa.array(sizes, batch.schema.field(size).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(lean(redact), schema)
