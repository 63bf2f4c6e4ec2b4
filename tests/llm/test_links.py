"""Components, n-gram join, paragraph dedup and top-k against brute force."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest
import pyspark.sql.types as T
from pyspark.sql import functions as F

from conftest import SF_SMALL
from llm.helpers import odd_docs, odd_rows, prose, union_find
from tidemark.llm import ngram_join as NJ
from tidemark.llm import paragraph_dedup as PD
from tidemark.llm import topk as TK
from tidemark.llm.components import components

DOCS = "doc_id long, text string"


def test_components_of_random_and_hot_graphs(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(230)] + [(900, i) for i in range(500, 800)]
    pairs += [(1000 + i, 1001 + i) for i in range(60)]                       # a chain
    edges = spark.createDataFrame([*pairs, (None, 3), (5, None), (7, 7)], "a long, b long")
    nodes = {n for p in pairs for n in p}
    want = {n: r for n, r in union_find(pairs, nodes).items() if n != r}
    assert {r.node: r.root for r in components(edges).collect()} == want
    assert components(edges.limit(0)).count() == 0


def shingles(text, size):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    import re
    w = re.findall(r"[^\x20\x09-\x0D]+", w)
    if not w:
        return set()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)}


def brute(rows, size=4, percent=85):
    sets = [shingles(t, size) for _, t in rows]
    links = []
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                common = len(a & b)
                if 100 * common >= percent * (len(a) + len(b) - common):
                    links.append((i, j))
    root = union_find(links, range(len(rows)))
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root[i]] = min(d, least.get(root[i], d))
    return sorted((d is None, d or 0, len(sets[i]), least[root[i]] if d is not None else -1) for i, (d, _) in enumerate(rows))


def ours(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id if r.doc_id is not None else -1) for r in df.collect())


def families(seed, n_big):
    """Families of near copies, one of them large, and passages that many documents share."""
    rng = random.Random(seed)
    common = prose(rng, 60)
    rows = []

    def edited(text, edits):
        w = text.split()
        for _ in range(edits):
            w[rng.randrange(len(w))] = "q%d" % rng.randrange(10 ** 6)
        return " ".join(w)

    for size in (1, 2, 3, 8, 40, n_big):
        base = prose(rng, rng.choice([9, 30, 90, 200]) if size != n_big else 120)
        rows += [edited(base, rng.randrange(0, 4)) for _ in range(size)]
    rows += [prose(rng, rng.randrange(2, 40)) + " " + common + " " + prose(rng, rng.randrange(2, 40)) for _ in range(60)]
    rows += [prose(rng, 50) for _ in range(40)]
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    rows = list(zip(ids, rows))
    rows += [(rows[i][0], rows[i + 1][1]) for i in range(0, 60, 3)]          # an id with two texts
    return rows + rows[:20]                                                  # and repeated rows


@pytest.mark.parametrize("seed,n_big", [(1, 60), (2, 330)])
def test_ngram_join_equals_brute_force(spark, seed, n_big):
    rows = families(seed, n_big)
    df = spark.createDataFrame(rows, DOCS).repartition(7)
    assert ours(NJ.ngram_components(df)) == brute(rows)


def test_ngram_join_of_odd_and_empty_tables(spark):
    assert ours(NJ.ngram_components(odd_docs(spark))) == brute([(i, t) for i, t, *_ in odd_rows()])
    assert NJ.ngram_components(odd_docs(spark, [])).count() == 0
    kept = NJ.one_of_each(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    gone = {d for _, d, _, c in brute([(i, t) for i, t, *_ in odd_rows()]) if c not in (-1, d)}
    assert ids == [i for i in range(18) if i not in gone]                     # repeated rows once
    assert kept.where("doc_id IS NULL").count() == 2


def test_linked_sets_share_a_signature():
    """For any classes of tokens, two sets that link have a signature in common."""
    rng = np.random.default_rng(4)
    linked = 0
    for _ in range(1500):
        n = int(rng.integers(7, 160))
        base = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
        out, into = rng.integers(0, max(2, n // 7), 2)
        other = np.unique(np.concatenate([rng.permutation(base)[out:], rng.integers(0, 2 ** 63, into).astype(np.uint64)]))
        common = len(np.intersect1d(base, other))
        if 100 * common < 85 * (len(base) + len(other) - common) or np.array_equal(base, other):
            continue
        linked += 1
        cells = (np.union1d(base, other) >> np.uint64(32)).astype(np.uint32)
        second = np.sort(cells[rng.random(len(cells)) < rng.choice([0, .3, .9, 1.0])])
        third = np.sort(second[rng.random(len(second)) < rng.choice([0, .5, 1.0])])
        a, b = (NJ.signatures(s, second, third, 85) for s in (base, other))
        assert len(np.intersect1d(a, b))
    assert linked > 300


def test_band_plan_reaches_the_recall():
    for rows in (1, 2, 3):
        bands = PD.band_plan(0.8, 0.99, rows)
        assert 1 - (1 - 0.8 ** rows) ** bands >= 0.99 > 1 - (1 - 0.8 ** rows) ** (bands - 1)


def test_repeated_passages_are_found_and_clean_documents_left(spark):
    rng = random.Random(9)

    def unique(n):
        return " ".join("w%d" % rng.randrange(10 ** 7) + rng.choice(["", "", ".", ",", ".\n"]) for _ in range(n))

    passages = [unique(rng.randrange(55, 90)) for _ in range(12)]
    rows, with_passage = [], set()
    for p in passages:
        for _ in range(rng.randrange(2, 30)):
            with_passage.add(len(rows))
            rows.append((len(rows), unique(rng.randrange(3, 200)) + " " + p + " " + unique(rng.randrange(3, 200))))
    clean = [(len(rows) + i, unique(rng.randrange(1, 400))) for i in range(150)]
    df = spark.createDataFrame(rows + clean, DOCS).repartition(5)
    got = {r.doc_id: r for r in PD.substring_dedup(df).collect()}
    assert set(got) <= with_passage and len(got) >= 0.97 * len(with_passage)
    for doc, r in got.items():
        text = dict(rows)[doc]
        removed = sum(len(text[s["start"]:s["end"]].split()) for s in r.removed)
        assert removed == r.n_removed and (r.kept_in != [doc] or not removed)
    cut = {r.doc_id: r.text for r in PD.without_repeats(df, PD.substring_dedup(df)).collect()}
    assert len(cut) == len(rows) + len(clean) and all(cut[i] == t for i, t in clean)
    for doc, r in got.items():
        text = dict(rows)[doc]
        for s in reversed(r.removed):
            text = text[:s["start"]] + text[s["end"]:]
        assert cut[doc] == text


def test_near_paragraphs_are_verified_by_jaccard(spark):
    rng = random.Random(12)
    base = ["v%d" % rng.randrange(10 ** 6) for _ in range(40)]
    rows = [(1, "\n".join([" ".join(base)])), (2, " ".join(base[:-1])), (3, " ".join(base[:20] + ["z%d" % i for i in range(20)]))]
    found = PD.repeated_paragraphs(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.doc_id for r in found} >= {1, 2}


def test_shared_windows_travel_as_word_numbers_and_spans_are_found_again(spark):
    """A window's row holds no more than its document and word number; spans are those of the text, in code points."""
    rng = random.Random(21)
    shared = " ".join("wört%d" % rng.randrange(10 ** 6) for _ in range(60))
    own = [" ".join("é%d\u2003x%d" % (k, rng.randrange(10 ** 6)) for _ in range(30)) for k in range(3)]
    rows = [(1, own[0] + " \n " + shared), (2, own[1] + " " + shared + " ü " + own[0]), (3, shared + "\t"), (3, shared + "\t"), (4, own[2])]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    assert set(PD.repeated_windows(PD._rows(df, "doc_id", "text")).columns) == {"doc_id", "text_hash", "at", "kept_in", "kept"}
    got = {r.doc_id: r for r in PD.substring_dedup(df).collect()}
    assert set(got) == {1, 2, 3} and got[1].n_removed == 0
    spans = {k: [rows[k - 1][1][s.start:s.end] for s in r.removed] for k, r in got.items()}
    assert spans == {1: [], 2: [shared, own[0]], 3: [shared]} and got[3].kept_in == [1]


def test_shared_keys_travel_packed_and_come_back_one_row_a_text(spark):
    """Keys that documents share against brute force: rare ones, some that a pack holds very often, and some that
    only one document has, with repeated rows and one id for two texts."""
    from tidemark.llm import shared_places as SP
    from tidemark.llm.textblocks import blocks, span_hashes, words

    def keys(batch):
        for base, data, offsets in blocks(batch.column(2)):
            starts, ends, row = words(data, offsets, "space")
            yield base + row, span_hashes(data, starts, ends), np.arange(len(row)) - np.searchsorted(row, row)

    rng = random.Random(23)
    rows = [(i - 50, " ".join([*("c%d" % rng.randrange(4) for _ in range(3)), *("s%d" % rng.randrange(900) for _ in range(4)), "u%d" % i])) for i in range(400)]
    rows += [(7, "own " * 300 + "s1"), (7, "c1 s2 s2 own"), (8, ""), (9, None), (-51, "c2 s3 c2"), *rows[:30]]
    docs = PD._rows(spark.createDataFrame([(10 ** 12 * (i % 3) + i, t) for i, t in rows], DOCS).repartition(2), "doc_id", "text").cache()
    places = {}
    texts = {(r.doc_id, r.text_hash): r.text for r in docs.collect()}
    for (doc, text_hash), text in texts.items():
        for at, word in enumerate((text or "").split()):
            places.setdefault(word, []).append((doc, text_hash, at))
    want = {}
    for p in places.values():
        if len({doc for doc, *_ in p}) > 1:
            for doc, text_hash, at in p:
                want.setdefault((doc, text_hash), set()).add((at, (doc, text_hash, at) == min(p), min(p)[0]))
    assert max(map(len, places.values())) > 4 * SP.CROWD and {len(p) for p in places.values()} >= {1, 2, 3}
    found = SP.shared_places(docs, keys, "test")
    assert found.columns == ["doc_id", "text_hash", "places", "kept_in"]
    got = found.collect()
    assert len(got) == len(want)                              # one row per text, none by key
    for r in got:
        _, at, kept = SP.unpack(pa.array([bytes(r.places)]))
        assert set(zip(at.tolist(), kept.tolist(), SP.unpack_ids(pa.array([bytes(r.kept_in)])).tolist())) == want[r.doc_id, r.text_hash]
    assert SP.shared_places(docs.limit(0), keys, "test").count() == 0
    docs.unpersist()


def test_paragraphs_travel_without_shingles_and_sets_are_built_again(spark):
    """A paragraph's row is its node and place; the sets of those asked for are the text's, also in a block of several rows."""
    rng = random.Random(22)
    rows = [(i, "\n".join(" ".join("s%d" % rng.randrange(10 ** 6) for _ in range(rng.randrange(1, 30))) for _ in range(6))) for i in range(30)]
    docs = PD._rows(spark.createDataFrame([*rows, rows[3]], DOCS).repartition(2), "doc_id", "text")
    every = PD._all_paragraphs(docs)
    assert set(every.columns) == {"node", "doc_id", "text_hash", *PD.PLACE}
    some = every.where("doc_id % 3 = 0").select("node", "doc_id", "text_hash", "at")
    got = {r.node: bytes(r.tokens) for r in PD._sets(docs, some).collect()}
    want = {}
    for _, text in rows[::3]:
        raw = np.frombuffer(text.encode(), np.uint8)
        *_, flat, many = PD.paragraph_sets(raw, np.array([0, len(raw)]))
        upto = np.concatenate([[0], np.cumsum(many)])
        want |= {int(n): flat[a:b].tobytes() for n, a, b in zip(PD._nodes(flat, many), upto[:-1], upto[1:])}
    assert len(want) > 30 and got == want


def test_materialize_leaves_no_shuffle_files(spark):
    from tidemark.session import SHUFFLE_CLEANUP, materialize

    def files():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
        names = set()
        while blocks.hasNext():
            names.add(blocks.next().getName())
        return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}

    before, was = files(), spark.conf.get(SHUFFLE_CLEANUP, None)
    df = spark.range(20_000).repartition(4, "id").groupBy((F.col("id") % 5000).alias("k")).agg(F.count("*").alias("n"))
    table = materialize(df, "shuffled")
    deadline = time.time() + 10
    while files() - before and time.time() < deadline:
        time.sleep(0.1)
    assert not files() - before and spark.conf.get(SHUFFLE_CLEANUP, None) == was
    assert table.count() == 5000 and df.count() == 5000                       # what it was made from still runs


def test_paragraph_dedup_of_odd_and_empty_tables(spark):
    got = {r.doc_id for r in PD.substring_dedup(odd_docs(spark)).collect()}
    assert got == {5, 6, 7, 8, 9}                             # the texts that occur in several documents
    assert PD.substring_dedup(odd_docs(spark, [])).count() == 0


def fresh(rng, n):
    return ["u%d" % rng.randrange(10 ** 9) for _ in range(n)]


def test_every_passage_of_51_words_is_found_to_its_ends(spark):
    rng, rows, want = random.Random(21), [], {}
    for _ in range(400):
        passage = fresh(rng, 51)
        for copy in range(2):
            head = fresh(rng, rng.randrange(0, 60))
            text = " ".join(head + passage + fresh(rng, rng.randrange(0, 60)))
            if copy:
                start = len(" ".join(head)) + bool(head)
                want[len(rows)] = [(start, start + len(" ".join(passage)))]
            rows.append((len(rows), text))
    got = {r.doc_id: r for r in PD.substring_dedup(spark.createDataFrame(rows, DOCS).repartition(6)).collect()}
    assert set(got) == {d for d, _ in rows}
    # near copies may take some of the words around a passage along
    assert all(any(s.start <= a and b <= s.end for s in got[d].removed) for d, [(a, b)] in want.items())
    assert sum([(s.start, s.end) for s in got[d].removed] == want[d] for d in want) > 370


def test_repeated_rows_and_shared_ids(spark):
    rng = random.Random(23)
    p, q = " ".join(fresh(rng, 52)), " ".join(fresh(rng, 52))
    one, two = " ".join([*fresh(rng, 20), p, *fresh(rng, 20)]), " ".join([*fresh(rng, 20), p, *fresh(rng, 30)])
    clean, other = " ".join(fresh(rng, 150)), " ".join([q, *fresh(rng, 40)])
    rows = [(1, one), (2, two), (2, clean), (3, q + " x"), (4, other), (5, q), (5, q + " " + q)]
    once = spark.createDataFrame(rows, DOCS)
    twice = spark.createDataFrame(rows + rows[:5] * 2, DOCS).repartition(3)
    a, b = (sorted(map(tuple, PD.substring_dedup(df).collect())) for df in (once, twice))
    assert a == b and [r[0] for r in a] == [1, 2, 3, 4, 5, 5] and [r[2] for r in a[:2]] == [52, 52]
    cut = [(r.doc_id, r.text) for r in PD.without_repeats(twice, PD.substring_dedup(twice)).collect()]
    assert len(cut) == 17 and cut.count((2, clean)) == 3 and cut.count((1, one)) == 3
    assert cut.count((2, two.replace(p, ""))) == 3 and cut.count((4, other.replace(q, ""))) == 3


def test_short_copies_do_not_depend_on_their_neighbours(spark):
    rng, rows = random.Random(24), []
    for n in (30, 35, 40):
        for _ in range(60):
            text = " ".join(fresh(rng, n))
            rows += [(len(rows), text), (len(rows) + 1, text)]
    shuffled = random.Random(25).sample(rows, len(rows))
    a, b = (sorted(map(tuple, PD.substring_dedup(spark.createDataFrame(r, DOCS).repartition(k)).collect())) for r, k in ((rows, 1), (shuffled, 6)))
    assert a == b and [r[0] for r in a] == [d for d, _ in rows]
    assert all(r[3] == (len(dict(rows)[r[0]].split()) if r[0] % 2 else 0) for r in a)


def test_passages_in_lines_of_few_words(spark):
    rng, rows = random.Random(26), []
    for n in (60, 100):
        for _ in range(20):
            w = fresh(rng, n)
            passage = "\n".join(" ".join(w[i:i + 4]) for i in range(0, n, 4))
            for _ in range(2):
                rows.append((len(rows), "\n".join([" ".join(fresh(rng, 40)), passage, " ".join(fresh(rng, 40))])))
    got = {r.doc_id: r for r in PD.substring_dedup(spark.createDataFrame(rows, DOCS).repartition(4)).collect()}
    assert {d: r.n_repeated for d, r in got.items()} == {d: len(t.split()) - 80 for d, t in rows}


def test_near_copies_with_one_changed_word_against_brute_force(spark):
    rng, rows, lines, exact = random.Random(27), [], {}, set()
    for n in (50, 60, 80):
        for _ in range(60):
            base = fresh(rng, n)
            edited = list(base)
            edited[rng.randrange(n)] = "edit"
            for i, break_ in ((0, "\n"), (1, " ")):
                for w in (base, edited):
                    lines[len(rows)] = " ".join(w)
                    rows.append((len(rows), break_.join([" ".join(fresh(rng, 30)), " ".join(w), " ".join(fresh(rng, 30))])))
                    if i:
                        exact.add(len(rows) - 1)
    near = set()
    for d in range(0, len(rows), 2):
        a, b = shingles(lines[d], 5), shingles(lines[d + 1], 5)
        if len(a & b) >= 0.8 * len(a | b):
            near |= {d, d + 1}
    got = {r.doc_id for r in PD.substring_dedup(spark.createDataFrame(rows, DOCS).repartition(5)).collect()}
    assert len(near) > 600 and near & exact <= got and len(near & got) >= 0.99 * len(near)


def best(rows, k, is_query, scale=64.0):
    ok = [(i, np.floor(scale * np.array(v, float))) for i, v in rows
          if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, x in ok:
        if is_query(q):
            s = sorted((-int(x @ y), i) for i, y in ok if i != q and len(y) == len(x))[:k]
            out += [(q, r + 1, i, -m) for r, (m, i) in enumerate(s)]
    return sorted(out)


VEC = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("score", T.StringType())])


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    hot = rng.normal(size=8).astype(np.float32)
    vecs = [(rng.normal(size=8) * rng.choice([.1, 1, 5])).astype(np.float32) for _ in range(500)] + [hot] * 200 + [hot * np.float32(.5)] * 50
    vecs += [np.zeros(8, np.float32)] * 3 + [rng.normal(size=5).astype(np.float32) for _ in range(12)]
    rows = [(i, v.tolist()) for i, v in enumerate(vecs)]
    rows += [(None, [1.0] * 8), (5000, None), (5010, []), (5020, [1.0, None] * 4), (5030, [float("nan")] * 8), (5040, [float("inf")] * 8)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], VEC).repartition(3)
    got = sorted(map(tuple, TK.top_k(df, 20, F.col("vec_id") % 10 == 0).collect()))
    assert got == best(rows, 20, lambda i: i % 10 == 0)
    assert TK.top_k(df.limit(0), 20, F.col("vec_id") % 10 == 0).count() == 0


def test_top_k_of_large_vectors_is_exact(spark):
    rng = np.random.default_rng(31)
    rows = [(i, (rng.normal(size=6) * 10.0 ** rng.integers(0, 6)).astype(np.float32).tolist()) for i in range(300)]
    rows += [(300, [4.0e7, 1.0, 2.0, 3.0, 4.0, 5.0]), (301, [4.0e7, 1.0, 2.0, 3.0, 4.0, 6.0]), (302, [1.0, -2.0e8, 0.0, 0.0, 0.0, 1.0])]
    ints = {i: [int(np.floor(64.0 * x)) for x in np.array(v, np.float32).astype(float)] for i, v in rows}
    want = []
    for q in range(0, 303, 5):
        s = sorted((-sum(a * b for a, b in zip(ints[q], ints[i])), i) for i in ints if i != q)[:7]
        want += [(q, n + 1, i, -m) for n, (m, i) in enumerate(s)]
    assert max(abs(x[3]) for x in want) > 2 ** 53
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], VEC).repartition(3)
    assert sorted(map(tuple, TK.top_k(df, 7, F.col("vec_id") % 5 == 0).collect())) == sorted(want)
    with pytest.raises(Exception, match="64 bits"):
        TK.top_k(spark.createDataFrame([(0, [1e30], "x"), (1, [1.0], "x")], VEC), 1, F.col("vec_id") == 0).collect()


def test_pruning_keeps_every_candidate_that_reaches_the_bound():
    rng = np.random.default_rng(2)
    used = 0
    for _ in range(300):
        d = int(rng.integers(2, 12))
        c = np.floor(rng.normal(size=(200, d)) * rng.choice([3, 40], size=(200, 1)))
        c[:20] = np.floor(c[0] + rng.normal(size=(20, d)))
        c = c[np.argsort(-np.linalg.norm(c, axis=1))]
        lengths, q = np.linalg.norm(c, axis=1), np.floor(c[rng.integers(0, 20)] * rng.choice([.5, 1, 2]))
        score = c @ q
        bound = float(np.sort(score)[::-1][rng.integers(0, 15)])
        left = TK.survivors(q, float(np.linalg.norm(q)), bound, c, lengths, float(lengths[0]))
        assert set(np.flatnonzero(score >= bound)) <= set(left.tolist()) or bound <= 0
        used += len(left) < len(c)
    assert used > 50


def test_top_k_query_equals_brute_force(spark):
    from tidemark.llm import queries as Q
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    assert sorted(map(tuple, Q.op10_topk(spark, SF_SMALL).collect())) == best(rows, 20, lambda i: i % 20 == 0)


def test_linked_sets_share_a_partition_signature_and_parity_bounds_them():
    from tidemark.llm.components import parity_bits, partition_signatures
    rng, linked = np.random.default_rng(1), 0
    for _ in range(3000):
        n, percent = int(rng.integers(1, 260)), int(rng.choice([50, 80, 85]))
        base = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
        out, into = rng.integers(0, max(2, n // 4), 2)
        other = np.unique(np.concatenate([rng.permutation(base)[out:], rng.integers(0, 2 ** 63, into).astype(np.uint64)]))
        common = len(np.intersect1d(base, other))
        if not len(other) or 100 * common < percent * (len(base) + len(other) - common):
            continue
        linked += 1
        assert len(np.intersect1d(partition_signatures(base, percent), partition_signatures(other, percent)))
        differ = sum(int(x).bit_count() for x in (parity_bits(base) ^ parity_bits(other)).view(np.uint64))
        assert (100 + percent) * differ <= (100 - percent) * (len(base) + len(other))
    assert linked > 500


def test_a_family_of_near_copies_that_do_not_link_gives_few_candidates(spark):
    """Sets that all differ from each other by half as much again as linked ones share many signatures, but only
    pairs near the threshold are checked: before, nearly all of the 1770 pairs of the 60 sets were."""
    from tidemark.llm.components import SKETCH, WIDE, close_links, parity_bits, resigned
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2 ** 63, 400).astype(np.uint64)
    sets = {i: np.unique(np.concatenate([rng.permutation(base)[33:], rng.integers(0, 2 ** 63, 33).astype(np.uint64)])) for i in range(1, 61)}
    sets[70] = np.append(sets[40][:-1], np.uint64(7))                         # the one that links, not with the leader

    def link(a, b):
        common = len(np.intersect1d(sets[a], sets[b]))
        return 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common)

    assert [(a, b) for a in sets for b in sets if a < b and link(a, b)] == [(40, 70)]
    checked = []

    def verify(pairs):
        checked.append([(r.a, r.b) for r in pairs.collect()])
        return spark.createDataFrame([p for p in checked[-1] if link(*p)], "a long, b long")

    def resign(nodes):
        rows = [row for r in nodes.collect() for row in resigned(r.node, r.root, sets[r.node], 80).to_pylist()]
        return spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{c} long" for c in ["sig", "node", "n", "root", *WIDE]))

    held = spark.createDataFrame([(1, i, len(s), 1) for i, s in sets.items()], "sig long, node long, n long, leader long")
    bits = spark.createDataFrame([(i, *parity_bits(s).tolist()) for i, s in sets.items()], ", ".join(f"{c} long" for c in ["node", *SKETCH]))
    roots = close_links(held, bits, 80, verify, resign)
    assert [tuple(r) for r in roots.collect()] == [(70, 40)]
    assert (40, 70) in checked[1] and len(checked[1]) < 60


def test_filters_keep_columns_of_any_name(spark):
    text = " ".join(fresh(random.Random(40), 60))
    df = spark.createDataFrame([(1, text, "a", 1), (2, text, "b", 2), (3, "other words", "c", 3)], "doc_id long, text string, removed string, `x.y` int")
    kept = NJ.one_of_each(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]
    cut = PD.without_repeats(df, PD.substring_dedup(df))
    assert cut.columns == df.columns and {r.doc_id: (r.text, r.removed) for r in cut.collect()} == {1: (text, "a"), 2: ("", "b"), 3: ("other words", "c")}
