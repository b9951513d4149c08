"""Registered queries of the corpus operators and their DuckDB oracles."""

from __future__ import annotations

from tessera.session import load

from . import decontaminate, html_render, line_dedup, ngram_join, packing, periodic_runs, quality_cnn, sharding, spelling, substring_dedup, topk, toxicity, url_reputation

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn
    return deco


@query("op1_flow_resharding")
def op1(spark, sf_dir):
    """All documents into 16 byte-equal shards from a layout of 12 shards by source."""
    return sharding.reshard_documents(load(spark, sf_dir, "documents"), n_shards=16, n_old=12)


JACCARD_SQL = r"""
WITH RECURSIVE
d AS (SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT r, array_to_string(w[i : i + least(len(w), 5) - 1], ' ') AS g
      FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
c AS (SELECT r, list_aggregate(list_sort(list(g)), 'string_agg', '|') AS sig FROM s GROUP BY r),
k AS (SELECT c.r, d.doc_id, min(c.r) OVER (PARTITION BY sig) AS rep, min(d.doc_id) OVER (PARTITION BY sig) AS low FROM c JOIN d ON c.r = d.r),
t AS (SELECT s.r, s.g FROM s WHERE s.r IN (SELECT rep FROM k)),
p AS (SELECT a.r AS a, b.r AS b, count(*) AS i FROM t a JOIN t b ON a.g = b.g AND a.r < b.r GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON p.a = x.r JOIN n y ON p.b = y.r WHERE 100 * i >= 80 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach(a, b) AS (SELECT rep, rep FROM k GROUP BY rep UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
comp AS (SELECT reach.a AS rep, min(low) AS component_id FROM reach JOIN (SELECT DISTINCT rep, low FROM k) m ON reach.b = m.rep GROUP BY reach.a),
cnt AS (SELECT rep, min(doc_id) AS low, count(*) AS copies FROM k GROUP BY rep),
deg AS (SELECT e.a AS rep, sum(copies) AS links FROM e JOIN cnt ON e.b = cnt.rep GROUP BY e.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(comp.component_id, d.doc_id) AS component_id,
       CAST(coalesce(deg.links, 0) + coalesce(cnt.copies - 1, 0) AS BIGINT) AS n_links, coalesce(cnt.low, d.doc_id) AS class_id
FROM d LEFT JOIN n ON d.r = n.r LEFT JOIN k ON d.r = k.r LEFT JOIN comp ON k.rep = comp.rep
LEFT JOIN cnt ON k.rep = cnt.rep LEFT JOIN deg ON k.rep = deg.rep
"""


@query("op2_ngram_jaccard_join", JACCARD_SQL)
def op2(spark, sf_dir):
    """Near-duplicate groups of all documents: five-word shingles, Jaccard 0.8."""
    return ngram_join.jaccard_components(load(spark, sf_dir, "documents"), num=80, den=100)


@query("op3_compact_window_dedup")
def op3(spark, sf_dir):
    """Passages of at least 50 words that repeat across documents, one row per occurrence."""
    return substring_dedup.repeated_passages(load(spark, sf_dir, "documents"), min_words=50)


TOP_K_SQL = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 20 = 0),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 20
"""


@query("op4_block_top_k", TOP_K_SQL)
def op4(spark, sf_dir):
    """The 20 best integer inner products of every 20th vector among all others."""
    return topk.top_k(load(spark, sf_dir, "embeddings"), k=20, every=20)


@query("op5_byte_cnn_quality")
def op5(spark, sf_dir):
    """Quality probability of every document."""
    return quality_cnn.score_documents(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"), threshold=0.3)


DECONTAMINATION_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n,
               array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
grams AS (SELECT k, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
          FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT g.k, g.i, g.n, w.item_id FROM grams g JOIN win w ON g.g = w.g AND g.n = w.n),
pos AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT k, i, n FROM hit)) GROUP BY k),
its AS (SELECT k, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
        FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY k)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(pos.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(its.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(its.ids, '')) AS items_sha256,
       coalesce(pos.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos ON d.k = pos.k LEFT JOIN its ON d.k = its.k
"""


@query("op6_benchmark_decontamination", DECONTAMINATION_SQL)
def op6(spark, sf_dir):
    """Words of every document that lie in a 10-word window of a benchmark item."""
    out = decontaminate.contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), window=10)
    return out.drop("hit_spans")


@query("op7_best_fit_packing")
def op7(spark, sf_dir):
    """All documents in sequences of at most 4096 tokens of the word BPE vocabulary."""
    return packing.pack_documents(load(spark, sf_dir, "documents"), packing.public_vocabulary("word_bpe_49k.json"), capacity=4096)


@query("op8_toxicity")
def op8(spark, sf_dir):
    """Toxicity of every document after noisy-channel deobfuscation."""
    return toxicity.score_documents(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"), threshold=0.5)


URL_SQL = r"""
WITH u AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
p AS (SELECT *, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain,
             list_extract(string_split(host, '.'), -1) AS suffix FROM h),
o AS (SELECT host, domain, suffix, y FROM p
      JOIN (SELECT doc_id, max(quality) AS y FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id) l ON p.page_id = l.doc_id),
hh AS (SELECT host, count(*) AS n, sum(y) AS y FROM o GROUP BY host),
dd AS (SELECT domain, count(*) AS n, sum(y) AS y FROM o GROUP BY domain),
ss AS (SELECT suffix, count(*) AS n, sum(y) AS y FROM o GROUP BY suffix),
g AS (SELECT coalesce(sum(y) / CAST(nullif(count(*), 0) AS DOUBLE), 0.5) AS p0 FROM o),
lv AS (SELECT 'h' AS l, n, y FROM hh UNION ALL SELECT 'd', n, y FROM dd UNION ALL SELECT 's', n, y FROM ss),
m AS (SELECT l, count(*) - 1 AS free, sum(n) - sum(n * n) / CAST(sum(n) AS DOUBLE) - (count(*) - 1) AS room,
             sum((y - n * p0) * (y - n * p0) / n) AS s, any_value(p0) AS p0 FROM lv, g GROUP BY l),
kk AS (SELECT l, CASE WHEN free < 1 OR room <= 0 OR p0 <= 0 OR p0 >= 1 THEN 20.0
                      ELSE 1 / least(greatest((s / (p0 * (1 - p0)) - free) / room, 1.0 / 201), 1.0 / 3) - 1 END AS k FROM m),
c AS (SELECT coalesce((SELECT k FROM kk WHERE l = 'h'), 20.0) AS kh, coalesce((SELECT k FROM kk WHERE l = 'd'), 20.0) AS kd,
             coalesce((SELECT k FROM kk WHERE l = 's'), 20.0) AS ks, (SELECT p0 FROM g) AS p0),
f AS (SELECT p.page_id, p.host, p.path, coalesce(hh.n, 0) + kh AS w,
             (coalesce(hh.y, 0) + kh * ((coalesce(dd.y, 0) + kd * ((coalesce(ss.y, 0) + ks * p0) / (coalesce(ss.n, 0) + ks)))
                                        / (coalesce(dd.n, 0) + kd))) / (coalesce(hh.n, 0) + kh) AS mean
      FROM p CROSS JOIN c LEFT JOIN hh ON p.host = hh.host LEFT JOIN dd ON p.domain = dd.domain LEFT JOIN ss ON p.suffix = ss.suffix),
r AS (SELECT *, mean - 1.645 * sqrt(mean * (1 - mean) / (w + 1)) AS bound,
             CASE WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                  WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
                  WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
                  WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
                  WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule FROM f)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN bound >= 0.7 THEN 'allow' ELSE 'block' END AS verdict,
       round(mean, 6) AS mean, round(bound, 6) AS bound
FROM r
"""


@query("op9_url_reputation", URL_SQL)
def op9(spark, sf_dir):
    """Verdict on every page url by rules, else by shrunken host reputation."""
    return url_reputation.judge(load(spark, sf_dir, "pages"), load(spark, sf_dir, "labels"))


@query("op10_html_rendering")
def op10(spark, sf_dir):
    """All visible text of every page, laid out as plain text."""
    return html_render.extract_text(load(spark, sf_dir, "pages"))


@query("op11_periodic_runs")
def op11(spark, sf_dir):
    """Periodic runs of at least 12 words in every document, some of them planted by the rule of ``plant_runs``."""
    planted = periodic_runs.plant_runs(load(spark, sf_dir, "documents"))
    return periodic_runs.run_digest(periodic_runs.find_runs(planted, min_words=12)).drop("n_words", "runs")


SPELLING_SQL = r"""
WITH tab AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
                                                  FROM (SELECT unnest(range(256)) AS i))),
d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+') AS ws FROM documents),
o AS (SELECT doc_id, w, count(*) AS c FROM (SELECT doc_id, unnest(ws) AS w FROM d) GROUP BY 1, 2),
b AS (SELECT doc_id, w, c, CAST(doc_id AS VARCHAR) || ':' || w AS s FROM o),
x AS (SELECT doc_id, w, c, [ascii(ch) FOR ch IN string_split(s, '')] AS cps FROM b),
u AS (SELECT doc_id, w, c, flatten([CASE WHEN p < 128 THEN [p] ELSE [192 + p // 64, 128 + p % 64] END FOR p IN cps]) AS bytes FROM x),
h AS (SELECT w, c, CASE WHEN doc_id IS NULL THEN 1 ELSE xor(list_reduce([4294967295] || bytes, lambda a, y: xor(a // 256, t[CAST(xor(a, y) % 256 AS INTEGER) + 1])), 4294967295) END AS h FROM u, tab),
r AS (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, CAST(h % length(w) AS INTEGER)) || substr(w, CAST(h % length(w) AS INTEGER) + 2) ELSE w END AS word, c FROM h),
v AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM r WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
del AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
near AS (SELECT a.word AS a, b.word AS b FROM del a JOIN del b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
         UNION SELECT del.word, v.word FROM del JOIN v ON del.cut = v.word UNION SELECT v.word, del.word FROM del JOIN v ON del.cut = v.word),
best AS (SELECT a AS word, count(*) AS n_near, first(b ORDER BY v.n DESC, b ) AS top, max(v.n) AS m FROM near JOIN v ON near.b = v.word GROUP BY a),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * v.n THEN top END AS form, CASE WHEN m >= 5 * v.n THEN m END AS form_n FROM v LEFT JOIN best USING (word))
SELECT word, form, n, n_near, form_n, root
FROM (WITH RECURSIVE walk(word, z) AS (SELECT word, word FROM f UNION ALL SELECT walk.word, f.form FROM walk JOIN f ON walk.z = f.word WHERE f.form IS NOT NULL)
      SELECT f.*, walk.z AS root FROM f JOIN walk ON f.word = walk.word JOIN f g ON walk.z = g.word WHERE g.form IS NULL)
"""


@query("op12_spelling_variants", SPELLING_SQL)
def op12(spark, sf_dir):
    """Words of at least 6 letters and 5 occurrences with their spelling variants; one run in 199 loses a letter first."""
    return spelling.variants_of_documents(load(spark, sf_dir, "documents"), min_chars=6, min_count=5, ratio=5, alter=spelling.delete_by_crc(199))


LINE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, i, ls[i] AS line, translate(regexp_replace(ls[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
      FROM (SELECT r, doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
t AS (SELECT k, max(doc_id) AS top, count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) AS n
      FROM l WHERE length(k) >= 20 GROUP BY k),
m AS (SELECT l.r, l.doc_id, l.i, l.line, coalesce(t.n >= 3 AND l.doc_id IS DISTINCT FROM t.top, false) AS gone FROM l LEFT JOIN t ON l.k = t.k)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY r
"""


@query("op13_line_dedup", LINE_SQL)
def op13(spark, sf_dir):
    """Lines of at least 20 characters that three documents share stay in the largest doc_id only."""
    return line_dedup.line_digest(load(spark, sf_dir, "documents"), min_chars=20, min_docs=3).drop("keep")
