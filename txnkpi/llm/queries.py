"""The operators as queries over the given tables, one each, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnkpi.llm import (
    backoff, compression, decontamination, divergence, langid, licenses, minhash, mixing, pii, quotations, suffixes,
    trie, warc,
)
from txnkpi.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def _compression(spark: SparkSession, folder: str) -> DataFrame:
    return compression.quality_rules(documents(spark, folder))


def _langid(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = langid.learn(docs.filter(~held))
    return langid.predict(docs, model, held_out=held)


def _licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_scan(documents(spark, folder))


def _pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pseudonymised(documents(spark, folder), pii.session_key(spark))


def _winnowing(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contamination(documents(spark, folder), documents(spark, folder, "benchmark"))


def _mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_plan(documents(spark, folder))


def _minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, folder))


def _quotations(spark: SparkSession, folder: str) -> DataFrame:
    return quotations.link_quotations(documents(spark, folder, "conversations"))


def _suffixes(spark: SparkSession, folder: str) -> DataFrame:
    found = suffixes.without_repeats(documents(spark, folder))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def _backoff(spark: SparkSession, folder: str) -> DataFrame:
    return backoff.backoff_scores(documents(spark, folder))


def _trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(documents(spark, folder, "conversations"), regraft=True)


def _divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.source_divergence(documents(spark, folder))


def _warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(documents(spark, folder, "pages"))


def queries() -> dict[str, Query]:
    return {
        "op1_surrogates": _pii,
        "op2_winnowing": _winnowing,
        "op3_compression_bands": _compression,
        "op4_ppm_language": _langid,
        "op5_license_rules": _licenses,
        "op6_water_filling": _mixing,
        "op7_quotation_links": _quotations,
        "op8_suffix_trees": _suffixes,
        "op9_stupid_backoff": _backoff,
        "op10_bottom_k": _minhash,
        "op11_prefix_trie": _trie,
        "op12_source_divergence": _divergence,
        "op13_warc": _warc,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_winnowing": WINNOWING, "op6_water_filling": MIXING, "op8_suffix_trees": REPEATS, "op10_bottom_k": BOTTOM_K,
        "op11_prefix_trie": TRIE, "op12_source_divergence": DIVERGENCE, "op13_warc": WARC,
    }


WINNOWING = r"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), item_window AS (
  SELECT DISTINCT item_id, n, array_to_string(w[s + 1 : s + n], ' ') AS g
  FROM (
    SELECT item_id, w, least(len(w), 10) AS n, unnest(range(len(w) - least(len(w), 10) + 1)) AS s
    FROM item WHERE len(w) > 0)
), doc AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), hit AS (
  SELECT doc_id, s, d.n, item_id
  FROM (
    SELECT doc_id, n, s, array_to_string(w[s + 1 : s + n], ' ') AS g
    FROM (
      SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS s
      FROM doc JOIN (SELECT DISTINCT n FROM item_window) ON len(w) >= n)) AS d
  JOIN item_window AS i ON d.n = i.n AND d.g = i.g
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered ON doc.doc_id = covered.doc_id LEFT JOIN found ON doc.doc_id = found.doc_id
"""

MIXING = r"""
WITH sized AS (
  SELECT doc_id, coalesce('s' || source, '~') AS source_key,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents
), source AS (
  SELECT source_key, CAST(sum(size) AS BIGINT) AS source_size,
    [3, 1, 2][(row_number() OVER (ORDER BY source_key) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source_key
), level AS (
  SELECT source_key, weight, source_size, row_number() OVER before AS place,
    (1.5::DOUBLE * sum(source_size) OVER () - sum(2 * source_size) OVER before + 2 * source_size)
      / (sum(weight) OVER () - sum(weight) OVER before + weight) AS l
  FROM source
  WINDOW before AS (ORDER BY 2 * source_size / weight, source_key)
), chosen AS (
  SELECT coalesce(arg_min(l, place) FILTER (2 * source_size > l * weight), 'infinity'::DOUBLE) AS l FROM level
), share AS (
  SELECT source_key, source_size, least(CAST(2 * source_size AS DOUBLE), weight * chosen.l) AS target
  FROM source CROSS JOIN chosen
), rest AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole
  FROM share
), placed AS (
  SELECT doc_id, size, source_size, target, whole,
    target - whole * source_size AS rest,
    sum(size) OVER (PARTITION BY sized.source_key ORDER BY k, size ROWS UNBOUNDED PRECEDING) AS until
  FROM sized JOIN rest ON sized.source_key = rest.source_key
)
SELECT doc_id, size, source_size, target,
  CAST(size * (whole + CASE WHEN rest > 0 AND until - size / 2 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""

BOTTOM_K = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, array_to_string(w[s + 1 : s + 5], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, least(len(w), 1)))) AS s FROM doc))
), size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), link AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
    FROM shingle AS x JOIN shingle AS y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN size AS p ON p.doc_id = a JOIN size AS q ON q.doc_id = b
  WHERE 100 * common >= 85 * (p.n + q.n - common)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM doc
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), least_id AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc.doc_id, CAST(coalesce(size.n, 0) AS BIGINT) AS n_shingles, component_id,
  doc.doc_id = component_id AS kept
FROM doc JOIN least_id ON doc.doc_id = least_id.a LEFT JOIN size ON doc.doc_id = size.doc_id
"""


REPEATS = r"""
WITH doc AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), place AS (
  SELECT doc_id, s, array_to_string(w[s + 1 : s + 13], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(len(w) - 12)) AS s FROM doc WHERE len(w) > 12)
), again AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY g) AS least FROM place) WHERE least < doc_id
), gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS p FROM again
), word AS (
  SELECT doc_id, unnest(w) AS x, unnest(range(len(w))) AS p FROM doc
), kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN kept ON doc.doc_id = kept.doc_id
"""


TRIE = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
    lambda k, d: list_reduce([xor(k, d), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a >> 1, 3988292384 * (a & 1))))) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), head AS (
  SELECT c.conv_id, pos, r, x FROM c JOIN t ON t.conv_id = c.base AND pos < h
), turns AS (
  SELECT * FROM head UNION ALL
  SELECT t.conv_id, pos - h + coalesce(taken, 0), r, x
  FROM t JOIN c ON t.conv_id = c.conv_id AND pos >= h
  LEFT JOIN (SELECT conv_id, count(*) AS taken FROM head GROUP BY conv_id) AS m ON m.conv_id = t.conv_id
), prefix AS (
  SELECT conv_id, pos + 1 AS depth, length(x) AS n,
    string_agg(md5(r) || md5(x), '') OVER (PARTITION BY conv_id ORDER BY pos) AS p
  FROM turns
  UNION ALL SELECT conv_id, 0, 0, '' FROM c
), node AS (
  SELECT p, depth, any_value(n) AS n, min(conv_id) AS conv_id, count(*) AS n_convs FROM prefix GROUP BY p, depth
), ending AS (
  SELECT p, sha256(string_agg(conv_id, ',' ORDER BY conv_id)) AS hash
  FROM (SELECT conv_id, arg_max(p, depth) AS p FROM prefix GROUP BY conv_id) GROUP BY p
), kids AS (
  SELECT p[: 64 * (depth - 1)] AS p, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL
), tree AS (
  SELECT top.p, sum((y.n_convs - 1) * y.n) AS saved, count(*) FILTER (kids.p IS NULL) AS n_leaves
  FROM node AS top JOIN node AS y ON starts_with(y.p, top.p) LEFT JOIN kids ON kids.p = y.p
  GROUP BY top.p
)
SELECT node.conv_id, CAST(node.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, node.n_convs,
  coalesce(n_children, 0) AS n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
  coalesce(hash, sha256('')) AS ends_sha256
FROM node JOIN tree ON tree.p = node.p
LEFT JOIN node AS up ON up.depth = node.depth - 1 AND up.p = node.p[: 64 * (node.depth - 1)]
LEFT JOIN kids ON kids.p = node.p LEFT JOIN ending ON ending.p = node.p
"""

DIVERGENCE = r"""
WITH doc AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'), []) AS w, row_number() OVER () AS d
  FROM documents
), word AS (
  SELECT lang, source, d, unnest(w) AS term FROM doc
), kept AS (
  SELECT lang, term FROM word GROUP BY lang, term HAVING count(DISTINCT d) >= 10
), size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang
), used AS (SELECT lang, source, term, count(*) AS n FROM word JOIN kept USING (lang, term) GROUP BY ALL
), grp AS (
  SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce(total, 0) AS total
  FROM (SELECT DISTINCT lang, source FROM doc) AS g LEFT JOIN size USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM used GROUP BY ALL) AS s ON s.lang = g.lang AND s.source = g.source
), dense AS (
  SELECT grp.lang, grp.source, kept.term, coalesce(n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // (total + 2 * v) AS p
  FROM grp JOIN kept ON kept.lang = grp.lang
  LEFT JOIN used ON used.lang = grp.lang AND used.source = grp.source AND used.term = kept.term
), whole AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM used GROUP BY ALL)
  JOIN (SELECT lang, sum(total) AS total, any_value(v) AS v FROM grp GROUP BY lang) USING (lang)
), gap AS (
  SELECT a.lang, a.source, b.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
  FROM grp AS a JOIN grp AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN dense AS x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN dense AS y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  WHERE x.term IS NULL OR y.term IS NOT NULL
  GROUP BY ALL
), part AS (
  SELECT lang, source, 'pair' AS part, item, coalesce(value, 0) AS value FROM gap
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM dense JOIN whole USING (lang, term)
  WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM part)
WHERE part = 'pair' OR rank <= 10
"""

WARC = """
WITH page AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS digest FROM pages
), first AS (
  SELECT digest, min(page_id) AS first_id FROM page GROUP BY digest
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, page.digest AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM page JOIN first USING (digest)
"""
