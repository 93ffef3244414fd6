"""Queries of this folder's operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.llm.ann import nearest
from adpulse.llm.common import table
from adpulse.llm.exact_dedup import exact_dedup
from adpulse.llm.hard_negatives import hard_negatives, shifted_sevenths
from adpulse.llm.html_extract import extract
from adpulse.llm.langid import identify
from adpulse.llm.merkle import lowered_thirds, manifest
from adpulse.llm.mixing import systematic_copies
from adpulse.llm.near_dedup import near_duplicates
from adpulse.llm.packing import pack
from adpulse.llm.pii import personal_data
from adpulse.llm.sharding import assign_shards
from adpulse.llm.substring_dedup import remove_repeats
from adpulse.llm.token_files import write

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


@_query("op1_pii")
def op1(spark, sf_dir):
    return personal_data(table(spark, sf_dir, "documents"))


@_query("op2_packing")
def op2(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))


@_query("op3_substring_dedup", r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 11, 1))) AS i FROM d),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM s),
f AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS m FROM g) WHERE m < doc_id),
c AS (SELECT DISTINCT doc_id, i + o AS p FROM f, range(13) t(o)),
p AS (SELECT d.doc_id, t.p, d.w[t.p] AS word FROM d, unnest(range(1, len(w) + 1)) t(p)),
k AS (
  SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.p) AS kept, count(*) AS n FROM p ANTI JOIN c USING (doc_id, p)
  GROUP BY p.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
""")
def op3(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@_query("op4_sharding")
def op4(spark, sf_dir):
    return assign_shards(table(spark, sf_dir, "documents"), 16)


@_query("op5_language_id")
def op5(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents"))


@_query("op6_near_dedup", r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN [w[1]] ELSE [w[i], w[i + 1]] END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  WHERE 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
r(doc_id, other) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.other),
c AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
SELECT c.doc_id, coalesce(n, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
""")
def op6(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


@_query("op7_nearest_neighbours")
def op7(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@_query("op8_exact_dedup", r"""
SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents)
""")
def op8(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents")).drop("row_id")


@_query("op9_mixing", r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM d GROUP BY source),
levels AS (  -- level * weight is a source's share unless its cap is smaller; only capped sources' levels are tried
  SELECT DISTINCT 3.0 * source_size / weight AS level FROM s UNION SELECT 0.0),
tried AS (
  SELECT level, (SELECT sum(source_size) FROM s)
      - (SELECT coalesce(sum(3 * source_size), 0) FROM s WHERE 3.0 * source_size / weight <= level) AS remain,
    (SELECT coalesce(sum(weight), 0) FROM s WHERE 3.0 * source_size / weight > level) AS weights
  FROM levels),
chosen AS (
  SELECT remain, weights, level FROM tried
  WHERE weights > 0 AND remain >= level * weights ORDER BY level DESC LIMIT 1),
t AS (
  SELECT source, source_size, CASE WHEN 3.0 * source_size / weight <= (SELECT level FROM chosen)
      THEN CAST(3 * source_size AS DOUBLE)
      ELSE CAST(weight * (SELECT remain FROM chosen) AS DOUBLE) / CAST((SELECT weights FROM chosen) AS DOUBLE) END AS target
  FROM s),
ordered AS (
  SELECT d.doc_id, d.source, size, source_size, target, size * 16 > target AS large,
    row_number() OVER (PARTITION BY d.source, size * 16 > target ORDER BY
      CASE WHEN size < 16 THEN size ELSE (length(bin(size)) - 4) * 8 + (size >> (length(bin(size)) - 4)) END,
      substr(md5(CAST(doc_id AS VARCHAR)), 1, 2), size, md5(CAST(doc_id AS VARCHAR)), doc_id) AS i,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
    CAST(('0x' || substr(md5('mix:' || coalesce(d.source, chr(0))), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS off
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
lg AS (
  SELECT *, CASE WHEN large THEN size * CAST(floor(i * rate + off) - floor((i - 1) * rate + off) AS BIGINT) END AS big
  FROM ordered),
rest AS (
  SELECT source, CAST(coalesce(sum(big), 0) AS BIGINT) AS gone,
    CAST(coalesce(sum(size) FILTER (NOT large), 0) AS BIGINT) AS small FROM lg GROUP BY source),
u AS (
  SELECT lg.*, gone, CASE WHEN small > 0 THEN least(3.0::DOUBLE, greatest(0.0::DOUBLE, (target - gone) / small))
    ELSE 0.0::DOUBLE END AS rate2 FROM lg JOIN rest ON lg.source IS NOT DISTINCT FROM rest.source),
v AS (
  SELECT u.*, c, CASE WHEN off + c / 32.0::DOUBLE >= 1 THEN off + c / 32.0::DOUBLE - 1
    ELSE off + c / 32.0::DOUBLE END AS shifted FROM u, range(32) r(c)),
w AS (
  SELECT *, size * CAST(floor(i * rate2 + shifted) - floor((i - 1) * rate2 + shifted) AS BIGINT) AS little FROM v),
b AS (
  SELECT source, c, abs(gone + CAST(coalesce(sum(little) FILTER (NOT large), 0) AS BIGINT) - target) AS miss
  FROM w GROUP BY source, c, gone, target),
best AS (SELECT source, first(c ORDER BY miss, c) AS c FROM b GROUP BY source)
SELECT doc_id, size, source_size, target, coalesce(big, little) AS taken
FROM w JOIN best ON w.source IS NOT DISTINCT FROM best.source AND w.c = best.c
""")
def op9(spark, sf_dir):
    out = systematic_copies(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@_query("op10_html_extraction")
def op10(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))


@_query("op11_merkle_manifest", """
WITH RECURSIVE bits AS (  -- CRC-32 of one byte, by its rule
  SELECT b, 0 AS step, CAST(b AS BIGINT) AS c FROM range(256) t(b)
  UNION ALL SELECT b, step + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE step < 8),
crcs AS (SELECT list(c ORDER BY b) AS crc FROM bits WHERE step = 8),
d AS (
  SELECT doc_id, lang, text, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
      || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ord(x) AS BIGINT) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')]),
      lambda c, x: xor(c >> 8, crc[xor(c & 255, x) + 1])), 4294967295) % 3 = 0 AS hit
  FROM documents, crcs),
leaves AS (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf, changed
  FROM (
    SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
      CASE WHEN hit THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '-')) END AS changed
    FROM d)),
t(lang, level, i, n, node) AS (  -- the trees of the languages
  SELECT lang, 0, i, count(*) OVER (PARTITION BY lang), leaf FROM leaves
  UNION ALL
  SELECT lang, level + 1, i // 8, (n + 7) // 8, sha256(string_agg(node, '' ORDER BY i)) FROM t WHERE n > 1
  GROUP BY lang, level, i // 8, n),
subroots AS (SELECT lang, level AS height, node, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i FROM t WHERE n = 1),
u(level, i, n, node) AS (  -- the tree of the subroots
  SELECT 0, i, count(*) OVER (), node FROM subroots
  UNION ALL
  SELECT level + 1, i // 8, (n + 7) // 8, sha256(string_agg(node, '' ORDER BY i)) FROM u WHERE n > 1
  GROUP BY level, i // 8, n),
ts AS (
  SELECT a.lang, a.level, a.i, coalesce(string_agg(b.node, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before,
    coalesce(string_agg(b.node, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS after
  FROM t a JOIN t b ON a.lang IS NOT DISTINCT FROM b.lang AND a.level = b.level AND a.i // 8 = b.i // 8
  WHERE a.n > 1 GROUP BY a.lang, a.level, a.i),
us AS (
  SELECT a.level, a.i, coalesce(string_agg(b.node, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before,
    coalesce(string_agg(b.node, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS after
  FROM u a JOIN u b ON a.level = b.level AND a.i // 8 = b.i // 8 WHERE a.n > 1 GROUP BY a.level, a.i),
path AS (  -- every leaf's siblings, level by level
  SELECT l.lang, l.i, ts.level, before, after FROM leaves l JOIN ts ON l.lang IS NOT DISTINCT FROM ts.lang
    AND ts.i = l.i >> CAST(3 * ts.level AS INTEGER)
  UNION ALL
  SELECT l.lang, l.i, s.height + us.level, before, after FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
    JOIN us ON us.i = s.i >> CAST(3 * us.level AS INTEGER)),
whole AS (
  SELECT lang, i, list(before ORDER BY level) AS b, list(after ORDER BY level) AS a,
    sha256(string_agg(before || after, '' ORDER BY level)) AS proof FROM path GROUP BY lang, i),
ready AS (
  SELECT l.*, coalesce(b, []) AS b, coalesce(a, []) AS a, coalesce(proof, sha256('')) AS proof
  FROM leaves l LEFT JOIN whole w ON l.lang IS NOT DISTINCT FROM w.lang AND l.i = w.i),
f(doc_id, lang, leaf, proof, b, a, level, node) AS (
  SELECT doc_id, lang, leaf, proof, b, a, 0, coalesce(changed, leaf) FROM ready
  UNION ALL
  SELECT doc_id, lang, leaf, proof, b, a, level + 1, sha256(b[level + 1] || node || a[level + 1]) FROM f WHERE level < len(b))
SELECT f.doc_id, leaf, s.node AS subroot, u.node AS root, proof AS proof_sha256, f.node AS folded_root,
  f.node = u.node AS verified
FROM f JOIN subroots s ON f.lang IS NOT DISTINCT FROM s.lang JOIN u ON u.n = 1 WHERE f.level = len(b)
""")
def op11(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return manifest(docs, *lowered_thirds(F.col("doc_id"), F.col("text")))


@_query("op12_hard_negatives", """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score,
  score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
  AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= 5
""")
def op12(spark, sf_dir):
    return hard_negatives(shifted_sevenths(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)


@_query("op13_token_files")
def op13(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return write(docs).lookup(docs.select("doc_id"), with_ids=False)
