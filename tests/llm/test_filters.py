"""Toxicity, decontamination, secrets, URL filters and the pipeline."""

import hashlib
import random
import re
import string

import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from llm.helpers import odd_docs, odd_rows
from llm.test_links import shingles, union_find
from tidemark.llm import decontaminate as DC
from tidemark.llm import queries as Q
from tidemark.llm import secret_scan as SS
from tidemark.llm import toxicity as TX
from tidemark.llm import url_filters as UF
from tidemark.session import materialize

SF = "/root/testdata/sf0.01"


def test_toxicity_on_held_out_labels(spark):
    got = Q.op3_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    right = {(r.held_out, r.ok): r["n"] for r in got.groupBy("held_out", (F.col("predicted") == F.col("toxic")).alias("ok")).agg(F.count("*").alias("n")).collect()}
    assert right[(True, True)] >= 0.9 * (right[(True, True)] + right.get((True, False), 0))
    toxic = got.where("toxic = 1").agg(F.avg("score")).first()[0]
    assert toxic > 0.5 > 0.2 > got.where("toxic = 0").agg(F.avg("score")).first()[0]


def test_toxicity_of_odd_and_empty_tables(spark):
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, None), (3, 5), (None, 1), (5, 1), (6, 0), (7, 0)], "doc_id long, toxic int")
    model = TX.fit(odd_docs(spark), labels)
    out = TX.score(odd_docs(spark), model)
    assert out.count() == len(odd_rows()) and out.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert dict(out.dtypes)["score"] == "double" and sorted(out.columns) == sorted(odd_docs(spark).columns)
    empty = {r.score for r in out.where("text IS NULL OR text = ''").collect()}
    assert len(empty) == 1                                    # no features: the intercept
    assert TX.score(odd_docs(spark, []), model).count() == 0
    for some, want in ((labels.limit(0), 0.0), (labels.where("toxic = 1"), 1.0), (labels.where("toxic = 0"), 0.0)):
        scores = {round(r.score, 6) for r in TX.score(odd_docs(spark), TX.fit(odd_docs(spark), some)).collect()}
        assert scores == {want}


def words_of(text):
    low = "".join(chr(ord(c) + 32) if c in string.ascii_uppercase else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_hits(docs, items, window=10):
    wins = {}
    for item, text in items:
        w = words_of(text)
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            wins.setdefault(tuple(w[i:i + k]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words_of(text), set(), set()
        for k in {len(x) for x in wins}:
            for i in range(len(w) - k + 1):
                got = wins.get(tuple(w[i:i + k]))
                if got is not None:
                    hit |= set(range(i, i + k))
                    found |= got
        names = sorted(str(x) for x in found if x is not None)
        out.append((doc is None, doc or 0, len(w), len(hit), names))
    return sorted(out)


def bench_rows():
    odd = {i: t for i, t, *_ in odd_rows() if i is not None}
    return [(1, odd[5]), (2, None), (3, ""), (4, "two words"), (5, "--- !!"), (5, odd[8][:400]), (None, "trailing space"), (6, odd[5]), (7, "WINDOWS lines and emoji 😀😀")]


def test_decontamination_equals_brute_force(spark):
    docs = [(i, t) for i, t, *_ in odd_rows()]
    bench = spark.createDataFrame(bench_rows(), "item_id long, text string")
    got = DC.contamination(odd_docs(spark), bench)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_hit, list(r["items"])) for r in got.collect()) == brute_hits(docs, bench_rows())
    assert DC.contamination(odd_docs(spark, []), bench).count() == 0
    none = DC.contamination(odd_docs(spark), bench.limit(0)).collect()
    assert len(none) == len(docs) and not any(r.n_hit for r in none)
    kept = DC.decontaminate(odd_docs(spark), bench)
    hit = {(d, n) for d, i, n, h, _ in brute_hits(docs, bench_rows()) if h}
    assert kept.columns == odd_docs(spark).columns
    assert kept.count() == sum(1 for *_, h, _ in brute_hits(docs, bench_rows()) if not h) and hit
    cut = DC.decontaminate(odd_docs(spark), bench, remove="spans")
    assert cut.count() == len(docs) and cut.columns == odd_docs(spark).columns
    left = {r.doc_id: r.text for r in cut.collect() if r.doc_id is not None}
    assert not words_of(left[5]) and words_of(left[8]) and left[2] == "one" and left[1] is None


def brute_spans(text):
    text, out = text or "", []
    letters = {"a": "[aA]"}
    key = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k) for k in ("password", "passwd", "secret", "token"))
    assign = rf"""({key}|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out += [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{['assign', 'access', 'hex'][k]}:{a}:{b}" for a, k, b in sorted(out))


def secret_texts():
    rng = random.Random(4)
    parts = ["password", "PassWd", "api_key", "APIKEY", "ſecret", "token", " = ", ":", "'", '"', "abcd1234EFGH", "short", "AKIA", "ABCDEFGH12345678", "AKIA" * 5,
             "0123456789abcdef" * 2, "f" * 31, "f" * 40, " ", "é", "\n", "to", "ken", "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 20, "xoxb-1234567890ab"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(1500)]


def test_secrets_equal_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(secret_texts())] + [(i, t) for i, t, *_ in odd_rows()]
    got = SS.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    base = {"assign", "access", "hex"}
    ours = sorted((r.doc_id is None, r.doc_id or 0, ",".join(f"{s.kind}:{s.start}:{s.end}" for s in r.spans if s.kind in base)) for r in got)
    assert ours == sorted((i is None, i or 0, brute_spans(t)) for i, t in rows)
    kinds = {s.kind for r in got for s in r.spans}
    assert kinds == {r.kind for r in SS.RULES}
    assert SS.scan_secrets(odd_docs(spark, [])).count() == 0


def test_trigram_queries_hold_for_every_match():
    for rule in SS.RULES:
        query = SS.trigram_query(rule.pattern)
        for text in secret_texts():
            for m in re.finditer(rule.pattern, text, re.ASCII):
                low = m[0].lower().encode()
                have = {low[i:i + 3] for i in range(len(low))}
                assert query is None or all(any(s <= have for s in clause) for clause in query)
    assert SS.trigram_query(r"[0-9a-f]+") is None
    assert SS.trigram_query(r"ab") is None
    assert SS.trigram_query(r"abc|xyz") == ((frozenset({b"abc"}), frozenset({b"xyz"})),)
    assert SS.trigram_query(r"a?bcd.*efgh") == ((frozenset({b"bcd"}),), (frozenset({b"efg", b"fgh"}),))
    assert SS.trigram_query(r"(abc)*de") is None


def test_redaction_replaces_spans_and_lengths(spark):
    rows = [(1, "token=abcdefgh12 end", 20), (2, None, None), (3, "clean", 5), (4, "secret: " + "0a" * 20, 48)]
    out = {r.doc_id: r for r in SS.redact_secrets(spark.createDataFrame(rows, "doc_id long, text string, n_chars long"), length_col="n_chars").collect()}
    assert (out[1].text, out[1].n_chars) == ("[SECRET] end", 12)
    assert out[2].text is None and out[3].text == "clean" and out[4].text == "[SECRET]"      # overlapping spans: one mark


def test_url_filters_by_date(spark):
    day = "CAST('2024-01-%02d' AS DATE)"
    events = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{a}','{k}',{p},'{x}',{day % d if d else 'CAST(NULL AS DATE)'})" for a, k, p, x, d in [
        ("ads", "domain", "'example.com'", "add", 5), ("ads", "domain", "'example.com'", "remove", 10), ("ads", "domain", "'example.com'", "add", 20),
        ("spam", "prefix", "'a.example.com/x'", "add", 7), ("gone", "url", "'not a url'", "add", 1), ("ads", "domain", "NULL", "add", 1),
        ("ads", "domain", "'b.org'", "add", None), ("tie", "domain", "'tie.org'", "add", 3), ("tie", "domain", "'tie.org'", "remove", 3)])
        + " AS t(list, kind, pattern, action, day)")
    caps = [(1, "http://A.example.com/x/y?q", 4), (2, "http://a.example.com/x/y", 5), (3, "https://u:p@a.example.com:80/x", 9), (4, "http://example.com", 10),
            (5, "http://badexample.com/x", 6), (6, "not a url", 2), (7, None, 2), (8, "http://example.com/", None), (9, "http://example.com/", 25), (10, "http://tie.org/", 3),
            (1, "http://A.example.com/x/y?q", 4)]
    df = spark.createDataFrame(caps, "page_id long, url string, d int").selectExpr(
        "page_id", "url", "date_add(CAST('2023-12-31' AS DATE), d) AS day", "'x' AS host", "'y' AS key")
    got = sorted((r.id, list(r.matches)) for r in UF.evaluate(df, events).collect())
    ads, spam = "ads:domain:example.com", "spam:prefix:a.example.com/x"
    assert got == [(1, []), (1, []), (2, [ads]), (3, [ads, spam]), (4, []), (5, []), (6, ["gone:url:not a url"]), (7, []), (8, []), (9, [ads]),
                   (10, ["tie:domain:tie.org"])]
    assert UF.evaluate(df.limit(0), events).count() == 0
    assert UF.evaluate(df, events.limit(0)).where("size(matches) > 0").count() == 0


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, docs, SF_SMALL), "test-pipeline")
        out.append((name, docs.collect(), after.collect(), after.columns))
        docs = after
    return out


def test_pipeline_stages_equal_brute_force(spark, stages):
    columns = spark.read.parquet(f"{SF_SMALL}/documents.parquet").columns
    assert all(set(c) == set(columns) for *_, c in stages[:-1])
    (_, _, kept, _), (_, docs2, out2, _), (_, docs3, out3, _), (_, docs4, out4, _), (_, docs5, out5, _) = stages
    scored = TX.score(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), Q.toxicity_model(
        spark, spark.read.parquet(f"{SF_SMALL}/documents.parquet"), SF_SMALL)).where("score < 0.5")
    assert {r.doc_id for r in kept} == {r.doc_id for r in scored.collect()}
    sets = {r.doc_id: shingles(r.text, 5) for r in docs2}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = union_find(links, sets)
    assert {r.doc_id for r in out2} == {d for d, r in root.items() if d == r}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert {r.doc_id for r in out3} == {d for _, d, _, h, _ in brute_hits([(r.doc_id, r.text) for r in docs3], items) if not h}
    after = {r.doc_id: r for r in out4}
    for r in docs4:
        spans = brute_spans(r.text)
        assert (after[r.doc_id].text == r.text) == (not spans) and after[r.doc_id].n_chars == len(after[r.doc_id].text)
        assert not brute_spans(after[r.doc_id].text)
    sp = sentencepiece.SentencePieceProcessor(model_file=Q.vocabulary(Q.PIECES))
    assert len(out5) == len(docs5)
    for r in out5:
        assert list(r.piece_ids) == sp.encode(r.text) and r.n_pieces == len(r.piece_ids)


def test_pipeline_run_equals_its_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert sorted((r.doc_id, r.text, r.n_pieces) for r in got.collect()) == sorted((r.doc_id, r.text, r.n_pieces) for r in stages[-1][2])


def test_pipeline_stages_take_odd_and_empty_tables(spark):
    rows = [(i, t, "en", "s", len(t or "")) for i, t, *_ in odd_rows()]
    for part in (rows, []):
        docs = spark.createDataFrame(part, "doc_id long, text string, lang string, source string, n_chars long")
        for _, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, SF_SMALL), "test-pipeline")
        assert {"doc_id", "text", "lang", "source", "n_chars"} <= set(docs.columns)
        assert (docs.count() > 0) == bool(part)


def test_digest_of_spans(spark):
    got = Q.op9_secret_scan(spark, SF_SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert len(got) == len(texts)
    for r in got:
        assert r.base_sha256 == hashlib.sha256(brute_spans(texts[r.doc_id]).encode()).hexdigest()


def test_decontamination_without_a_broadcast_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(DC, "BROADCAST_BYTES", -1)
    bench = spark.createDataFrame(bench_rows(), "item_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_hit, r["items"]) for r in DC.contamination(odd_docs(spark), bench).collect())
    assert got == brute_hits([(r[0], r[1]) for r in odd_rows()], bench_rows())
    assert DC.contamination(odd_docs(spark, []), bench).count() == 0
    assert DC.contamination(odd_docs(spark), bench.limit(0)).where("n_hit > 0").count() == 0


def test_only_hashes_of_windows_are_dealt_out(spark, monkeypatch):
    seen = []
    real = DC.window_hits
    monkeypatch.setattr(DC, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(DC, "window_hits", lambda slots, windows: seen.append(real(slots, windows)) or seen[-1])
    DC.contamination(odd_docs(spark), spark.createDataFrame(bench_rows(), "item_id long, text string"))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = seen[0]._jdf.queryExecution().sparkPlan().toString() + seen[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    dealt = [c.dataType.simpleString() for c in seen[0].schema.fields]
    assert dealt == ["bigint", "bigint", "int"] and "Exchange" in plan
    asked = [x for x in plan.splitlines() if "isnotnull(h" in x or "left_semi" in x.lower()]
    assert asked                                             # NULL hashes go before the join


def brute_toxicity(rows, labels, tests):
    """Fit and score in plain Python: hashed n-grams by the model's own hash, the rest by the formulas."""
    import math
    import numpy as np

    def grams(text):
        data = np.frombuffer((text or "").encode(), np.uint8)
        return set(TX.features(data, np.array([0, len(data)]))[1].tolist())

    y = {}
    for d, t in labels:
        if d is not None and t in (0, 1):
            y[d] = max(t, y.get(d, 0))
    docs = [(grams(t), y[d]) for d, t in rows if d in y]
    n = [sum(c == k for c in y.values()) for k in (0, 1)]
    d = [sum(c == k for _, c in docs) for k in (0, 1)]
    count = {}
    for g, c in docs:
        for f in g:
            count.setdefault(f, [0, 0])[c] += 1
    kept = {}
    for f, (a, b) in count.items():
        p1, p0 = (b + 1) / (d[1] + 2), (a + 1) / (d[0] + 2)
        ratio = math.log(p1 / (1 - p1)) - math.log(p0 / (1 - p0))
        error = math.sqrt(1 / (b + 1) + 1 / (d[1] + 1 - b) + 1 / (a + 1) + 1 / (d[0] + 1 - a))
        if abs(ratio / error) >= TX.LEAST_Z:
            kept[f] = math.log(p1 / p0)
    names = sorted(kept)
    x = np.array([[kept[f] if f in g else 0.0 for f in names] for g, _ in docs])
    target = np.array([c for _, c in docs], float)
    w, b = np.zeros(len(names)), math.log((target.mean() + 1e-9) / (1 - target.mean() + 1e-9))
    m, v = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for t in range(1, TX.STEPS + 1):
        err = 1 / (1 + np.exp(-np.clip(x @ w + b, -40, 40))) - target
        g = np.append(x.T @ err + TX.RIDGE * w * 0.1, err.sum()) / len(target)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    b += math.log(n[1] / n[0]) - math.log(d[1] / d[0])
    weight = {f: w[i] * kept[f] for i, f in enumerate(names)}
    return [1 / (1 + math.exp(-max(-40, min(40, b + sum(weight.get(f, 0.0) for f in grams(t)))))) for _, t in tests]


def test_toxicity_equals_a_plain_fit_and_score(spark):
    rng = random.Random(8)
    rows = []
    for i in range(160):
        bad = i % 3 == 0
        rows.append((i, " ".join(rng.choice(["blork", "vex", "snarl"] if bad and rng.random() < .6 else ["tree", "river", "stone", "cloud", "é"]) for _ in range(rng.randrange(3, 25)))))
    rows += [(200, None), (201, ""), (202, "blork blork"), (203, "river")]
    labels = [(i, int(i % 3 == 0)) for i in range(130)] + [(200, 0), (None, 1), (7, None), (8, 1), (500, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = TX.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r.score for r in TX.score(docs, model).collect()}
    for (i, _), want in zip(rows, brute_toxicity(rows, labels, rows)):
        assert abs(got[i] - want) < 1e-4, i


def test_rows_of_one_labelled_id_are_one_of_the_sample(spark):
    rows = [(1, f"text {i % 50}") for i in range(5000)] + [(2, "other")]
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    sample, n0, n1 = TX._labelled_sample(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    got = sample.collect()
    assert len(got) == 2 and (n0, n1) == (1, 1)
    again, _, _ = TX._labelled_sample(spark.createDataFrame(rows[::-1], "doc_id long, text string").repartition(7), labels)
    assert sorted(map(tuple, got)) == sorted(map(tuple, again.collect()))
