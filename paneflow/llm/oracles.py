"""DuckDB SQL with the same result as the queries of this subpackage."""

from __future__ import annotations

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_BASE32 = """array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex_sha1, 1 + 10 * (i // 8), 10))::BIGINT >> (5 * (7 - i % 8))) & 31)::INT, 1)), '')"""

OP1 = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
         sha1(coalesce(html, '')) AS hex_sha1,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top
  FROM pages
)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM top THEN NULL ELSE top END AS refers_to
FROM p
"""

OP9 = f"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://')
      THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), h AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UP}', '{_LOW}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND prefix(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND prefix(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR suffix(host, '.org')) AND prefix(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/') THEN 'net/'
  END AS rule FROM h
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""

OP10 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM d
"""

OP6 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_sum(list_transform(embedding,
    lambda x: CASE WHEN x IS NULL OR NOT isfinite(x) THEN 1 ELSE 0 END)) = 0
    AND list_sum(list_transform(embedding, lambda x: abs(x::DOUBLE))) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, c.component_id,
       e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c ON c.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""

OP8 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'),
         '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), g AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1),
      lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS shingles
  FROM w
), t AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS s FROM g),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM t a JOIN t b ON a.s = b.s AND a.doc_id <> b.doc_id AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT g.doc_id, len(g.shingles)::BIGINT AS n_shingles, c.component_id
FROM g JOIN c ON c.a = g.doc_id
"""

# CRC-32 of a number in decimals, bit by bit.
_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT],
      list_transform(range(1, len(c::VARCHAR) + 1), lambda i: ascii(substr(c::VARCHAR, i::INT, 1))::BIGINT)),
    lambda a, b: list_reduce(list_concat([xor(a, b)], list_transform(range(8), lambda i: 0::BIGINT)),
      lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""

OP12 = rf"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id
      ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT c, list({{'role': role, 'text': text}} ORDER BY pos) AS turns FROM t GROUP BY c
), openings AS (
  SELECT *, ({_CRC32}) % 4 AS h FROM own
), rebuilt AS (
  SELECT o.c, list_concat(coalesce(list_slice(f.turns, 1, o.h), []),
                          list_slice(o.turns, o.h + 1, len(o.turns))) AS turns
  FROM openings o LEFT JOIN own f ON f.c = o.c - o.c % 20
), p AS (
  SELECT c, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt
), keyed AS (
  SELECT c, depth, depth = len(turns) AS ends, list_slice(turns, 1, depth) AS node,
    CASE WHEN depth > 0 THEN list_slice(turns, 1, depth - 1) END AS parent,
    CASE WHEN depth = 0 THEN 0
      ELSE len(regexp_extract_all(turns[depth].text, '[^\x20\x09-\x0D]+')) END AS words
  FROM p
), nodes AS (
  SELECT node, any_value(parent) AS parent, min(c) AS conv_id, depth, count(*) AS n_convs,
    max(words) AS words,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM keyed GROUP BY node, depth
), children AS (
  SELECT parent AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY parent
), sizes AS (
  SELECT n.*, coalesce(k.n, 0) AS n_children, (n.n_convs - 1) * n.words AS own_saved
  FROM nodes n LEFT JOIN children k USING (node)
), above AS (
  SELECT s.*, unnest(range(0, s.depth + 1)) AS d FROM sizes s
), below AS (
  SELECT list_slice(node, 1, d) AS node, sum(own_saved)::BIGINT AS saved_tokens,
    count(*) FILTER (n_children = 0) AS n_leaves
  FROM above GROUP BY 1
)
SELECT s.conv_id, s.depth, u.conv_id AS parent_conv_id, s.n_convs, s.n_children, b.n_leaves,
       b.saved_tokens, s.ends_sha256
FROM sizes s JOIN below b USING (node) LEFT JOIN nodes u ON s.depth > 0 AND u.node = s.parent
"""

ORACLES = {
    "op1_warc_revisits": OP1,
    "op6_embedding_dedup": OP6,
    "op8_ngram_join": OP8,
    "op9_url_filter": OP9,
    "op10_exact_dedup": OP10,
    "op12_conversation_trie": OP12,
}
