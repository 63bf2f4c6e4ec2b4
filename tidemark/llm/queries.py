"""The registered queries ``opN_<name>`` of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ann_graph as graphs
from tidemark.llm import decontaminate as clean
from tidemark.llm import merkle_log as merkle
from tidemark.llm import ngram_join as ngrams
from tidemark.llm import paragraph_dedup as paragraphs
from tidemark.llm import prefix_trie as tries
from tidemark.llm import secret_scan as secrets
from tidemark.llm import sentencepieces as pieces
from tidemark.llm import token_counts as counts
from tidemark.llm import token_store as store
from tidemark.llm import topk, toxicity
from tidemark.llm import url_filters as urls
from tidemark.session import scratch_path, ship_package

VOCABULARY = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
END_ID = 2


def vocabulary(name: str = VOCABULARY) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-store")
    store.write_store(table(spark, sf_dir, "documents"), path, vocabulary(), END_ID)
    return store.read_documents(spark, path)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), vocabulary(PIECES))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(table(spark, sf_dir, "documents"), vocabulary())


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = paragraphs.substring_dedup(table(spark, sf_dir, "documents"))
    spans = F.transform("removed", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return found.select("doc_id", "n_repeated", "n_removed", F.concat_ws(",", spans).alias("removed_spans"), "kept_in")


def held_out() -> F.Column:
    """The test fold: rows whose labels are never learned from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out())
    return toxicity.fit(docs, labels)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.ngram_components(table(spark, sf_dir, "documents")).drop("text_hash")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clean.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def _span_text(spans) -> F.Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def _draw(salt: str, x) -> F.Column:
    """A number below 2**28 that depends on ``x`` alone."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt), x).cast("binary")), 1, 7), 16, 10).cast("long")


def _dated_events(pages: DataFrame) -> DataFrame:
    """Dated list entries over what occurs in ``pages``: some domains are
    listed, taken off and listed again, some path prefixes listed for a while,
    some URLs listed for good."""
    host = urls.host_of(F.col("url"))
    labels = F.split(host, r"\.")
    domain = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 2, F.lit(1)), F.lit(3)), ".")
    prefix = F.concat(host, F.lit("/"), F.get(urls.segments_of(F.col("url")), F.lit(0)))

    def events(name, kind, pattern, share, steps):
        p = pages.select(pattern.alias("pattern")).where("pattern <> ''").distinct().where(_draw(name, F.col("pattern")) % share == 0)
        first = _draw(name + "-day", F.col("pattern")) % 600
        plan = F.array(*[F.struct(F.lit(a).alias("action"), F.date_add(F.lit("2023-01-01").cast("date"), (first + d).cast("int")).alias("day"))
                         for a, d in steps])
        return p.select(F.lit(name).alias("list"), F.lit(kind).alias("kind"), "pattern", F.explode(plan).alias("e")) \
            .select("list", "kind", "pattern", "e.action", "e.day")

    return events("adult", "domain", domain, 3, [("add", 0), ("remove", 90), ("add", 150)]) \
        .unionByName(events("spam", "prefix", prefix, 4, [("add", 0), ("remove", 120)])) \
        .unionByName(events("takedown", "url", F.col("url"), 10, [("add", 0)]))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    fetched = F.date_add(F.lit("2023-01-01").cast("date"), (_draw("fetch", F.col("url")) % 730).cast("int"))
    found = urls.evaluate(pages.withColumn("day", fetched), _dated_events(pages))
    return found.select(F.col("id").alias("page_id"), "host", F.col("day").alias("fetch_day"), F.size("matches").cast("long").alias("n_active"),
                        F.concat_ws(",", "matches").alias("matches"), (F.size("matches") > 0).alias("blocked"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    base = [r.kind for r in secrets.RULES if r.base]

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    n = [count(k) for k in base]
    own = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select("doc_id", *n, F.sha2(_span_text(own), 256).alias("base_sha256"), _span_text(F.col("spans")).alias("spans"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), 20, F.col("vec_id") % 20 == 0)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = tries.sequences(tries.turn_tokens(table(spark, sf_dir, "conversations")))
    turns = F.crc32(F.col("conv").cast("string").cast("binary")) % 6
    hundred = F.col("conv") - F.col("conv") % 100
    return tries.trie(tries.with_head_of(pieces, hundred, turns, 5, F.col("conv") % 100 == 0))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    found = merkle.manifest(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id", {"text": lower}, tampered)
    return found.audit().select(F.col("id").alias("doc_id"), "leaf", F.col("top").alias("subroot"), "root", F.col("siblings_sha256").alias("proof_sha256"),
                                F.col("folded").alias("folded_root"), "verified")


def op13_ann_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graphs.nearest(table(spark, sf_dir, "embeddings"), 5, F.col("vec_id") % 50 == 0)


QUERIES = {
    "op1_token_store": op1_token_store,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_ngram_join": op4_ngram_join,
    "op5_decontaminate": op5_decontaminate,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_token_counts": op7_token_counts,
    "op8_url_filters": op8_url_filters,
    "op9_secret_scan": op9_secret_scan,
    "op10_topk": op10_topk,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_ann_graph": op13_ann_graph,
}
# words as in the Spark query; one row per document window that equals an item's window
_OP5 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bl AS (SELECT item_id, w, least(len(w), 10) AS k FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, k, w[i:i + k - 1] AS win FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM bl)),
dw AS (SELECT r, k, i, w[i:i + k - 1] AS win FROM (
         SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bl) WHERE len(w) >= k)),
hit AS (SELECT dw.r, dw.i, dw.k, bw.item_id FROM dw JOIN bw ON dw.win = bw.win),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hit) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS xs FROM (SELECT DISTINCT r, item_id::VARCHAR AS x FROM hit) GROUP BY r)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(xs, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)"""

_OP10 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS z FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.z, c.z), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20"""

_OP4 = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, hash(sh) AS h FROM (SELECT doc_id, unnest(CASE WHEN len(w) >= 4
             THEN list_transform(range(1, len(w) - 2), lambda i: w[i:i + 3]) WHEN len(w) > 0 THEN [w] ELSE [] END) AS sh FROM d)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT x, y FROM c JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * i >= 85 * (nx.n + ny.n - i)),
both_ways AS MATERIALIZED (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach(x, y) AS (SELECT x, y FROM both_ways UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x),
least_of AS (SELECT x, min(y) AS m FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least_of ON least_of.x = d.doc_id"""

_OP8 = r"""
WITH p AS MATERIALIZED (SELECT row_number() OVER () AS r, page_id, url,
    lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
    list_filter(string_split(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS seg,
    DATE '2023-01-01' + (('0x' || substr(md5('fetch' || url), 1, 7))::BIGINT % 730)::INTEGER AS day FROM pages),
pats AS (SELECT DISTINCT 'adult' AS list, 'domain' AS kind, array_to_string(list_slice(string_split(host, '.'), greatest(len(string_split(host, '.')) - 2, 1), 1000), '.') AS pattern, 3 AS share FROM p
    UNION ALL SELECT DISTINCT 'spam', 'prefix', host || '/' || seg[1], 4 FROM p WHERE len(seg) > 0
    UNION ALL SELECT DISTINCT 'takedown', 'url', url, 10 FROM p),
kept AS (SELECT list, kind, pattern, DATE '2023-01-01' + (('0x' || substr(md5(list || '-day' || pattern), 1, 7))::BIGINT % 600)::INTEGER AS d0
    FROM pats WHERE pattern <> '' AND ('0x' || substr(md5(list || pattern), 1, 7))::BIGINT % share = 0),
iv AS (SELECT list, kind, pattern, d0 AS since, d0 + 90 AS until FROM kept WHERE kind = 'domain'
    UNION ALL SELECT list, kind, pattern, d0 + 150, NULL FROM kept WHERE kind = 'domain'
    UNION ALL SELECT list, kind, pattern, d0, d0 + 120 FROM kept WHERE kind = 'prefix'
    UNION ALL SELECT list, kind, pattern, d0, NULL FROM kept WHERE kind = 'url'),
k AS (SELECT r, day, 'url' AS kind, url AS key FROM p
    UNION ALL SELECT r, day, 'domain', array_to_string(list_slice(string_split(host, '.'), i, 1000), '.') FROM (SELECT *, unnest(range(1, len(string_split(host, '.')) + 1)) AS i FROM p WHERE host <> '')
    UNION ALL SELECT r, day, 'prefix', host || '/' || array_to_string(seg[1:i], '/') FROM (SELECT *, unnest(range(1, len(seg) + 1)) AS i FROM p WHERE host <> '')),
m AS (SELECT r, count(*) AS n, string_agg(x, ',' ORDER BY x) AS xs FROM (SELECT DISTINCT k.r, list || ':' || iv.kind || ':' || pattern AS x
    FROM k JOIN iv ON k.kind = iv.kind AND k.key = iv.pattern AND day >= since AND (until IS NULL OR day < until)) GROUP BY r)
SELECT page_id, host, day AS fetch_day, coalesce(n, 0) AS n_active, coalesce(xs, '') AS matches, n IS NOT NULL AS blocked FROM p LEFT JOIN m USING (r)"""

# crc32 of a number's digits, bit by bit
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split({0}::VARCHAR, '')]), lambda acc, y:
    list_reduce(list_prepend(xor(acc, y), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda v, k: xor(v >> 1, 3988292384 * (v & 1)))))"""

_OP11 = r"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, %s %% 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, t.i, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id %% 100 AND t.i <= h
      UNION ALL SELECT c.conv_id, 1000000 + t.i, role, text FROM c JOIN t USING (conv_id) WHERE t.i > h),
s AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY i) AS d, length(text) AS chars,
        sha256(string_agg(sha256(role) || sha256(text), '' ORDER BY i) OVER (PARTITION BY conv_id ORDER BY i)) AS p FROM r),
m AS MATERIALIZED (SELECT conv_id, 0 AS d, 0 AS chars, '' AS p FROM c UNION ALL SELECT * FROM s),
n AS MATERIALIZED (SELECT d, p, any_value(chars) AS chars, min(conv_id) AS rep, count(*) AS n FROM m GROUP BY d, p),
up AS MATERIALIZED (SELECT n.d, n.p, m.p AS pp FROM n JOIN m ON m.conv_id = n.rep AND m.d = n.d - 1),
k AS (SELECT d - 1 AS d, pp AS p, count(*) AS kids FROM up GROUP BY 1, 2),
x AS (SELECT n.*, coalesce(kids, 0) AS kids, (n - 1) * chars AS own FROM n LEFT JOIN k USING (d, p)),
b AS (SELECT a.d, a.p, sum((x.kids = 0)::INT)::BIGINT AS leaves, sum(x.own)::BIGINT AS saved FROM x JOIN m a ON a.conv_id = x.rep AND a.d <= x.d GROUP BY 1, 2),
e AS (SELECT d, p, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM (SELECT conv_id, max(d) AS d FROM m GROUP BY 1) JOIN m USING (conv_id, d) GROUP BY 1, 2)
SELECT x.rep AS conv_id, x.d::BIGINT AS depth, y.rep AS parent_conv_id, x.n AS n_convs, x.kids AS n_children, b.leaves AS n_leaves, b.saved AS saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM x JOIN b USING (d, p) LEFT JOIN up USING (d, p) LEFT JOIN n y ON y.d = x.d - 1 AND y.p = up.pp LEFT JOIN e ON e.d = x.d AND e.p = x.p""" % _CRC.format("conv_id")

# k: a language's tree, or the one over the subroots (its levels are numbered the same way)
_OP12 = r"""
WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS r, *, CASE WHEN doc_id IS NOT NULL AND %s %% 3 = 0
        THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS claimed, coalesce('+' || lang, '') AS k FROM documents),
l AS MATERIALIZED (SELECT r, doc_id, k, sha256(fields || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(fields || coalesce(strlen(claimed) || ':' || claimed, '-')) AS claim
      FROM (SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
             || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS fields FROM d)),
o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY k) AS n FROM l),
t(k, lev, i, n, h) AS (SELECT k, 0, i, n, leaf FROM o
    UNION ALL SELECT k, lev + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM t WHERE n > 1 GROUP BY k, lev, i // 8, n),
s AS MATERIALIZED (SELECT k, h, row_number() OVER (ORDER BY k) - 1 AS g, count(*) OVER () AS n FROM t WHERE n = 1),
u(lev, i, n, h) AS (SELECT 0, g, n, h FROM s
    UNION ALL SELECT lev + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM u WHERE n > 1 GROUP BY lev, i // 8, n),
top AS (SELECT h AS root FROM u WHERE n = 1),
run AS MATERIALIZED (SELECT k, lev, i // 8 AS j, list(h ORDER BY i) AS hs FROM t WHERE n > 1 GROUP BY 1, 2, 3),
up AS MATERIALIZED (SELECT lev, i // 8 AS j, list(h ORDER BY i) AS hs FROM u WHERE n > 1 GROUP BY 1, 2),
f(r, k, lev, i, h, sib) AS (SELECT r, k, 0, i, claim, '' FROM o
    UNION ALL SELECT r, f.k, f.lev + 1, i // 8, sha256(array_to_string(list_concat(hs[:i %% 8], [h], hs[i %% 8 + 2:]), '')),
       sib || array_to_string(list_concat(hs[:i %% 8], hs[i %% 8 + 2:]), '') FROM f JOIN run ON run.k = f.k AND run.lev = f.lev AND run.j = f.i // 8),
ft AS MATERIALIZED (SELECT f.r, f.k, s.g, s.h AS subroot, f.h, f.sib FROM f JOIN s USING (k) JOIN (SELECT k, max(lev) AS lev FROM t GROUP BY k) m ON m.k = f.k AND m.lev = f.lev),
z(r, lev, i, h, sib) AS (SELECT r, 0, g, h, sib FROM ft
    UNION ALL SELECT r, z.lev + 1, i // 8, sha256(array_to_string(list_concat(hs[:i %% 8], [h], hs[i %% 8 + 2:]), '')),
       sib || array_to_string(list_concat(hs[:i %% 8], hs[i %% 8 + 2:]), '') FROM z JOIN up ON up.lev = z.lev AND up.j = z.i // 8)
SELECT o.doc_id, o.leaf, ft.subroot, root, sha256(z.sib) AS proof_sha256, z.h AS folded_root, z.h = root AS verified
FROM o JOIN ft USING (r) JOIN z USING (r), top WHERE z.lev = (SELECT max(lev) FROM u)""" % _CRC.format("doc_id")

SQL: dict[str, str] = {
    "op12_merkle_manifest": _OP12,
    "op11_prefix_trie": _OP11,
    "op8_url_filters": _OP8,
    "op4_ngram_join": _OP4,
    "op10_topk": _OP10,
    "op5_decontaminate": _OP5,
}
