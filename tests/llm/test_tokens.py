"""Token store, token counts and SentencePiece against the libraries themselves."""

import random
import zlib

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from conftest import SF_SMALL
from llm.helpers import odd_docs, odd_rows
from tidemark.llm import queries as Q
from tidemark.llm import sentencepieces as SP
from tidemark.llm import token_counts as TC
from tidemark.llm import token_store as TS
from tidemark.llm.bpe import MemoEncoder
from tidemark.llm.textblocks import blocks
from tidemark.session import scratch_path

PATH, PIECES = Q.vocabulary(), Q.vocabulary(Q.PIECES)


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def texts(spark):
    return [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]


def ids_of(lib, text):
    return lib.encode(text or "", add_special_tokens=False).ids


def awkward(rng):
    parts = list("ab  \n\té1,.'") + ["the", " the", "'s", "　", " ", "<|endoftext|>", "中文", "😀", "\x1c", " ", "12", "  "]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(25)))


def test_memo_equals_library(lib, texts):
    import pyarrow as pa
    rng = random.Random(5)
    every = texts + [awkward(rng) for _ in range(3000)]
    enc = MemoEncoder(PATH, most=5000)                        # the memo starts anew many times
    got = []
    for _, data, offsets in blocks(pa.array(every), 1 << 14):
        ids, n = enc.encode(data, offsets)
        upto = np.concatenate([[0], np.cumsum(n)])
        got += [ids[a:b].tolist() for a, b in zip(upto, upto[1:])]
    assert got == [ids_of(lib, t) for t in every]


def test_splices_equal_library_and_widen(lib, texts):
    rng = random.Random(6)
    long = [" ".join(texts[:40]), "x" * 3000 + " y", "".join(awkward(rng) for _ in range(400)), "a" * 500 + " b" * 20 + "c" * 900]
    widened = 0
    for t in long:
        for chunk, overlap in ((200, 8), (333, 1), (64, 64)):
            ids, wide = TC.splice_ids(t, lib, chunk, overlap)
            assert ids == ids_of(lib, t)
            widened += wide
    assert widened > 0


def test_counts_of_odd_table(spark, lib):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in TC.token_counts(odd_docs(spark), PATH, huge_bytes=2000, chunk=700, overlap=16).collect())
    want = sorted((i is None, i or 0, len((t or "").encode()), len(ids_of(lib, t)), len(ids_of(lib, t)) > 1024) for i, t, *_ in odd_rows())
    assert got == want
    assert TC.token_counts(odd_docs(spark, []), PATH).count() == 0


def test_dac_random_access():
    rng = np.random.default_rng(1)
    for ids in (np.zeros(0, int), np.arange(3), rng.integers(0, 50_257, 5000), rng.integers(0, 2 ** 31, 777), np.array([255, 256, 65535, 65536, 0])):
        r = TS.Reader(TS.pack(ids))
        assert r.n == len(ids) and r.tokens(0, len(ids)).tolist() == ids.tolist()
        assert [r.token(i) for i in range(len(ids))] == ids.tolist()
        for _ in range(20):
            a, b = sorted(rng.integers(0, len(ids) + 1, 2).tolist())
            assert r.tokens(a, b).tolist() == ids[a:b].tolist()
        with pytest.raises(IndexError):
            r.token(len(ids))


def stored(spark, df, lib, rows, **kw):
    path = scratch_path(spark, "test-store")
    TS.write_store(df, path, PATH, 2, **kw)
    got = sorted(TS.read_documents(spark, path).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    encoded = {}
    for i, t in rows:
        x = ids_of(lib, t) + [2]
        encoded.setdefault(i, []).append((len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
        encoded[r.doc_id].remove((r.n_tokens, r.ids_crc32))
    assert not any(encoded.values())
    return path, at


def test_store_round_trip(spark, lib):
    stored(spark, odd_docs(spark), lib, [(i, t) for i, t, *_ in odd_rows()], segment_tokens=500)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    path, total = stored(spark, docs, lib, [(r.doc_id, r.text) for r in docs.collect()], segment_tokens=3000)
    flat = [i for r in docs.orderBy("doc_id").collect() for i in ids_of(lib, r.text) + [2]]
    asked = random.Random(2).sample(range(total), 200) + [total + 5]
    got = {r.position: r.token for r in TS.tokens_at(spark, path, spark.createDataFrame([(p,) for p in asked], "p long")).collect()}
    assert got == {p: flat[p] for p in asked if p < total}


def test_store_of_no_rows(spark):
    path = scratch_path(spark, "test-store")
    TS.write_store(odd_docs(spark, []), path, PATH, 2)
    assert TS.read_documents(spark, path).count() == 0


def test_queries_equal_library(spark, lib):
    docs = sorted(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: r for r in Q.op7_token_counts(spark, SF_SMALL).collect()}
    store = {r.doc_id: r for r in Q.op1_token_store(spark, SF_SMALL).collect()}
    at = 0
    for r in docs:
        ids = ids_of(lib, r.text)
        assert (got[r.doc_id].n_tokens, got[r.doc_id].n_bytes) == (len(ids), len(r.text.encode()))
        assert (store[r.doc_id].start, store[r.doc_id].n_tokens) == (at, len(ids) + 1)
        at += len(ids) + 1


def test_pieces_equal_library(spark, texts):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    m = SP.compile_model(PIECES)
    rng = random.Random(7)
    parts = list("ab  \n\tétheonr.,12▁中文😀ing\x00") + ["the", "  ", "    ", "hello", "--", "　", "ee", "thth", "ing"]
    for t in texts[:60] + ["".join(rng.choice(parts) for _ in range(rng.randrange(16))) for _ in range(4000)]:
        ids = sp.encode(t)
        assert m.encode(t) == ids, repr(t)
        assert m.decode(ids) == sp.decode(ids)


def test_pieces_of_odd_table(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    out = SP.decode(SP.encode(odd_docs(spark), PIECES), PIECES).collect()
    assert len(out) == len(odd_rows())
    for r in out:
        assert list(r.piece_ids) == sp.encode(r.text or "")
        assert r.decoded == sp.decode(list(r.piece_ids))
    assert SP.encode(odd_docs(spark, []), PIECES).count() == 0
    trip = SP.round_trip(odd_docs(spark), PIECES).collect()
    assert all(r.restored for r in trip)
    assert sorted(r.n_pieces for r in trip) == sorted(len(sp.encode(t or "")) for _, t, *_ in odd_rows())


def hand_made_model(kind, seed, charmap, fallback, collapse):
    """A model of random pieces and scores, many of them equal; nothing is trained."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    rng, m = random.Random(seed), pb.ModelProto()
    rule = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc" if charmap else "identity")
    spec = pb.ModelProto()
    spec.ParseFromString(rule.serialized_model_proto())
    m.normalizer_spec.CopyFrom(spec.normalizer_spec)
    m.normalizer_spec.add_dummy_prefix, m.normalizer_spec.remove_extra_whitespaces, m.normalizer_spec.escape_whitespaces = True, collapse, True
    m.trainer_spec.model_type, m.trainer_spec.byte_fallback = kind, fallback
    for text, type_ in [("<unk>", SP.UNKNOWN), ("<s>", SP.CONTROL), ("</s>", SP.CONTROL)] + [(f"<0x{i:02X}>", SP.BYTE) for i in range(256) if fallback]:
        m.pieces.add(piece=text, score=0.0, type=type_)
    chars = "▁abcdefé1中K"
    words = {"".join(rng.choice(chars) for _ in range(rng.choice([2, 2, 3, 4, 5]))) for _ in range(400)} | set(chars)
    for w in sorted(words):
        m.pieces.add(piece=w, score=-float(rng.choice([1, 2, 2.5, 3, 3.3, 7.123456])) * (1 if len(w) > 1 else 2), type=SP.NORMAL)
    return m.SerializeToString()


@pytest.mark.parametrize("charmap,fallback,collapse", [(False, False, False), (True, True, True), (True, False, True), (False, True, True), (True, True, False)])
def test_unigram_models_with_character_maps_equal_library(tmp_path, texts, charmap, fallback, collapse):
    raw = hand_made_model(SP.UNIGRAM, 5, charmap, fallback, collapse)
    path = tmp_path / "hand.model"
    path.write_bytes(raw)
    sp, m = sentencepiece.SentencePieceProcessor(model_proto=raw), SP.Transducer(str(path))
    rng = random.Random(9)
    parts = list("abcdefé1中K   \t\n▁zÉ") + ["Ａｂ", "①", "ﬁ", "　", "K", "é", "<tag>", "ab ", "Ｋ", "가", "  ", "abc", "\u200b", "\u00a0", "\x01", "ｶﾞ", "㌔"]
    for t in texts[:30] + ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(3000)]:
        ids = sp.encode(t)
        assert m.normalise(t) == sp.normalize(t), repr(t)
        assert m.encode(t) == ids, repr(t)
        assert m.decode(ids) == sp.decode(ids), repr(t)


def test_unigram_model_over_a_table(spark, tmp_path):
    raw = hand_made_model(SP.UNIGRAM, 6, True, True, True)
    path = tmp_path / "hand.model"
    path.write_bytes(raw)
    sp = sentencepiece.SentencePieceProcessor(model_proto=raw)
    small = [r for r in odd_rows() if len(r[1] or "") < 50_000]
    for r in SP.encode(odd_docs(spark, small), str(path)).collect():
        assert list(r.piece_ids) == sp.encode(r.text or "")
    trips = SP.round_trip(odd_docs(spark, small), str(path)).collect()
    assert sorted(r.n_pieces for r in trips) == sorted(len(sp.encode(t or "")) for _, t, *_ in small)


def test_pieces_query_equals_library(spark):
    import struct
    import zlib
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    for r in Q.op6_sentencepiece(spark, SF_SMALL).collect():
        ids = sp.encode(docs[r.doc_id])
        assert (r.n_pieces, r.n_byte_pieces, r.restored) == (len(ids), sum(sp.is_byte(i) for i in ids), True)
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def test_unigram_lattice_takes_the_shortest_path():
    m = object.__new__(SP.Transducer)
    m.kind, m.fallback, m.unknown, m.unknown_weight = SP.UNIGRAM, False, 0, -19.0
    m.spelling, m.score = ["<unk>", "a", "b", "ab", "abc", "bc"], [0, -1.0, -1.0, -1.5, -9.0, -1.2]
    m.pieces = SP.Automaton([(p, (i, m.score[i])) for i, p in enumerate(m.spelling) if i])
    assert m.path("abc") == [1, 5]                            # a + bc = 2.2 beats ab + c and abc
    assert m.path("abz") == [3, 0]


def test_pieces_leave_a_task_block_by_block():
    """A row batch of any size is encoded and handed on in blocks of ``ENCODE_BYTES``; all rows and columns stay."""
    import pyarrow as pa
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    from tidemark.llm import sentencepieces
    from tidemark.llm.queries import PIECES, vocabulary

    class Task:
        columns, schema = ["n", "text"], StructType([StructField("n", LongType()), StructField("text", StringType())])

        def drop(self, name):
            return self

        def mapInArrow(self, run, schema):
            return run

    texts = [None, "", "é" * 200_000] + ["a few words and 12 numbers " * 40] * 900 + ["tail"]
    batch = pa.RecordBatch.from_pydict({"n": list(range(len(texts))), "text": texts})
    model = vocabulary(PIECES)
    got = list(sentencepieces.encode(Task(), model)(iter([batch, batch.slice(0, 0)])))
    sizes = [sum(len((t or "").encode()) for t in b.column(1).to_pylist()) for b in got]
    assert len(got) > 3 and all(n <= sentencepieces.ENCODE_BYTES or b.num_rows == 1 for n, b in zip(sizes, got))
    whole = pa.Table.from_batches(got)
    assert whole.column("n").to_pylist() == list(range(len(texts))) and whole.column("text").to_pylist() == texts
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    ids = whole.column("piece_ids").to_pylist()
    assert [ids[i] for i in (0, 1, 2, 3, len(texts) - 1)] == [library.encode(texts[i] or "") for i in (0, 1, 2, 3, len(texts) - 1)] and ids[3:-1] == [ids[3]] * 900
