"""The queries that SQL can express, for DuckDB."""

from __future__ import annotations

_MINHASH = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
grams AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) = 0 THEN []::VARCHAR[]
    WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g
  FROM words
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
  SELECT x, y FROM shared s JOIN sizes p ON p.doc_id = s.x JOIN sizes q ON q.doc_id = s.y
  WHERE 100 * s.n >= 80 * (p.n + q.n - s.n)
),
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (
  SELECT DISTINCT x AS node, x AS other FROM both_ways
  UNION SELECT r.node, b.y FROM reach r JOIN both_ways b ON b.x = r.other
),
lowest AS (SELECT node, min(other) AS low FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(l.low, d.doc_id) AS component_id,
       d.doc_id = coalesce(l.low, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN lowest l ON l.node = d.doc_id
"""

_MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents
),
sums AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sized GROUP BY source
),
ranked AS (
  SELECT *, 2 * source_size AS cap, 150 * sum(source_size) OVER () AS budget,
         coalesce(sum(2 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS given,
         sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
  FROM sums WINDOW o AS (ORDER BY source_size * (10 // weight), source)
),
judged AS (SELECT *, 100 * cap * open_weight <= (budget - 100 * given) * weight AS stops FROM ranked),
plan AS (
  SELECT source, source_size, CASE WHEN stops THEN cap::DOUBLE ELSE
    ((budget - 100 * sum(CASE WHEN stops THEN cap ELSE 0 END) OVER ()) * weight)::DOUBLE
    / (100 * sum(CASE WHEN stops THEN 0 ELSE weight END) OVER ())::DOUBLE END AS target
  FROM judged
),
rated AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM plan)
SELECT s.doc_id, s.size::BIGINT AS size, r.source_size, r.target,
  (s.size * (floor(rate) + CASE WHEN
     ('0x' || substr(md5('20011104:' || coalesce(s.doc_id::VARCHAR, '-') || ':' || coalesce(s.text, '')), 1, 13))::BIGINT
     / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized s JOIN rated r ON s.source IS NOT DISTINCT FROM r.source
"""

#: canonical links and refreshes with absolute targets, as the given pages have no others
_URLS = r"""
WITH RECURSIVE rules(rule, ruling) AS (VALUES
  ('org/', 'allow'), ('example.org/es/', 'block'), ('example.org/en/1', 'block'),
  ('com/fr/', 'allow'), ('com/de/', 'block')),
seen AS (
  SELECT page_id, url, html,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
),
noded AS (
  SELECT *, CASE WHEN contains(regexp_extract(url, '(?s)^([^#]*)', 1), '://') THEN
    translate(regexp_extract(url, '(?s)^(.*?)://', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    || '://' || host || regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1) END AS node
  FROM seen
),
tags AS (
  SELECT node AS src, unnest(regexp_extract_all(coalesce(html, ''), '(?is)<(?:link|meta)\b[^>]*>')) AS tag
  FROM noded WHERE node IS NOT NULL
),
edges AS (
  SELECT DISTINCT src, regexp_extract(target, '(?s)^([^#]*)', 1) AS dst FROM (
    SELECT src, CASE
      WHEN regexp_matches(tag, '(?is)\brel\s*=\s*["'']?canonical\b')
      THEN regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)
      WHEN regexp_matches(tag, '(?is)\bhttp-equiv\s*=\s*["'']?refresh\b')
      THEN regexp_extract(tag, '(?is)url\s*=\s*["'']?([^"''\s>]+)', 1) END AS target
    FROM tags) WHERE contains(target, '://')
),
both_ways AS (SELECT src, dst FROM edges WHERE src != dst UNION SELECT dst, src FROM edges WHERE src != dst),
reach AS (
  SELECT DISTINCT src AS node, src AS other FROM both_ways
  UNION SELECT r.node, b.dst FROM reach r JOIN both_ways b ON b.src = r.other
),
lowest AS (SELECT node, min(other) AS low FROM reach GROUP BY node),
ends AS (
  SELECT low, regexp_extract(node, '(?s)^.*?://([^/?#]*)', 1) AS host,
    regexp_extract(node, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM lowest
),
hits AS (
  SELECT DISTINCT host, path, rule, ruling FROM (SELECT host, path FROM seen UNION SELECT host, path FROM ends), rules
  WHERE ('.' || host) LIKE '%.' || split_part(rule, '/', 1)
    AND starts_with(path, substr(rule, strpos(rule, '/')))
),
chosen AS (
  SELECT host, path, rule, ruling FROM hits
  QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(rule) DESC, ruling) = 1
),
known AS (
  SELECT n.page_id, n.host, n.path, c.rule, c.ruling, coalesce(l.low, n.node) AS alias_group
  FROM noded n LEFT JOIN chosen c USING (host, path) LEFT JOIN lowest l ON l.node = n.node
)
SELECT page_id, host, path, rule, alias_group, coalesce(ruling, CASE WHEN alias_group IN (
    SELECT low FROM ends JOIN chosen USING (host, path) GROUP BY low HAVING min(ruling) = 'block')
  THEN 'block' ELSE 'allow' END) AS verdict
FROM known
"""

_WARC = r"""
WITH sized AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages
),
first AS (SELECT payload_digest, max(page_id) AS page FROM sized WHERE payload_bytes >= 1000 GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page IS NULL OR page = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page != page_id THEN page END AS refers_to
FROM sized LEFT JOIN first USING (payload_digest)
"""

#: all pairs; the search finds every link of tables as small as these
_LINKS = """
WITH RECURSIVE good AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x != 0)) > 0
),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.vec_id != b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95
),
reach AS (
  SELECT DISTINCT x AS node, x AS other FROM links
  UNION SELECT r.node, l.y FROM reach r JOIN links l ON l.x = r.other
),
lowest AS (SELECT node, min(other) AS low FROM reach GROUP BY node),
counts AS (SELECT x AS node, count(*) AS n FROM links GROUP BY x)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, coalesce(l.low, e.vec_id) AS component_id,
  e.vec_id = coalesce(l.low, e.vec_id) AS kept
FROM embeddings e LEFT JOIN counts c ON c.node = e.vec_id LEFT JOIN lowest l ON l.node = e.vec_id
"""

#: lines are numbered from 0; of a recurring template's, the first of the smallest id stays
_LINES = r"""
WITH owned AS (SELECT DISTINCT doc_id, text, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
lines AS (
  SELECT doc_id, text, nr, list_transform(regexp_extract_all(parts[nr + 1], '[^\x20\x09-\x0D]+'),
    lambda w: CASE WHEN regexp_matches(w, '[0-9]') THEN '<*>' ELSE w END) AS form
  FROM (SELECT *, unnest(range(len(parts))) AS nr FROM owned)
),
index AS (SELECT doc_id, text, nr, form, len(form) AS size, form[1:3] AS start FROM lines WHERE len(form) > 0),
forms AS (SELECT form, size, start, count(DISTINCT (doc_id, text)) AS docs FROM index GROUP BY ALL),
leaves AS (SELECT size, start, count(*) AS n FROM forms GROUP BY ALL),
tokens AS (
  SELECT DISTINCT doc_id, text, size, start, place, form[place] AS token
  FROM (SELECT *, unnest(range(1, size + 1)) AS place FROM index JOIN leaves USING (size, start) WHERE n > 1)
),
common AS (
  SELECT size, start, place, token FROM tokens WHERE token != '<*>' GROUP BY ALL HAVING count(*) >= 5
),
cut AS (
  SELECT form, size, start, place, CASE WHEN n = 1 THEN form[place] WHEN c.token IS NULL THEN '<*>' ELSE c.token END AS token
  FROM (SELECT *, unnest(range(1, size + 1)) AS place FROM forms JOIN leaves USING (size, start)) f
  LEFT JOIN common c USING (size, start, place) WHERE c.token IS NULL OR c.token = form[place]
),
cut_once AS (SELECT form, place, max(token) FILTER (token != '<*>') AS token FROM cut GROUP BY ALL),
spread AS (
  SELECT f.form, f.size, unnest(range(1, f.size + 1)) AS place FROM forms f
),
templates AS (
  SELECT s.form, any_value(s.size) AS size, list(coalesce(c.token, '<*>') ORDER BY s.place) AS template
  FROM spread s LEFT JOIN cut_once c USING (form, place) GROUP BY s.form
),
fixed AS (
  SELECT *, len(list_filter(template, lambda w: w != '<*>')) AS fixed,
    size >= 10 AND NOT list_contains(form, '<*>') AS long
  FROM templates
),
hits AS (
  SELECT i.doc_id, i.text, i.nr, f.template AS template, CASE WHEN f.size < 3 THEN 20 WHEN f.fixed = f.size THEN 5 ELSE 10 END AS needed
  FROM index i JOIN fixed f USING (form)
  WHERE f.fixed >= CASE WHEN f.size < 3 THEN 0.5 ELSE 0.7 END * f.size
  UNION ALL
  SELECT i.doc_id, i.text, i.nr, ['long'] || i.form, 2 FROM index i JOIN fixed f USING (form) WHERE f.long
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY template ORDER BY doc_id NULLS LAST, text, nr) AS nth FROM hits
),
recurring AS (SELECT template FROM hits GROUP BY template HAVING count(DISTINCT (doc_id, text)) >= any_value(needed)),
gone AS (
  SELECT doc_id, text, list(DISTINCT nr) AS gone FROM ranked SEMI JOIN recurring USING (template) WHERE nth > 1 GROUP BY ALL
)
SELECT d.doc_id, CASE WHEN g.gone IS NULL THEN d.text ELSE array_to_string(
    [x for x, i in string_split(d.text, chr(10)) if NOT list_contains(g.gone, i - 1)], chr(10)) END AS text,
  CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END::BIGINT AS n_lines,
  coalesce(len(g.gone), 0)::BIGINT AS n_dropped
FROM documents d LEFT JOIN gone g ON g.doc_id IS NOT DISTINCT FROM d.doc_id AND g.text = d.text
"""

#: texts as hexadecimal digits, so that bytes can be cut; strings are told apart by their MD5
_REPEATS = """
WITH docs AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, ''))::BIGINT AS n FROM documents
),
-- cut from blocks, as a place in a long text is found by counting
blocks AS (
  SELECT doc_id, n, b, substr(h, 2000 * b + 1, 2198) AS block
  FROM (SELECT *, unnest(range(0, (n - 100) // 1000 + 1)) AS b FROM docs WHERE n >= 100)
),
keyed AS (
  SELECT doc_id, 1000 * b + i AS p, md5_number(substr(block, 2 * i + 1, 200)) AS k
  FROM (SELECT *, unnest(range(0, least(1000, n - 99 - 1000 * b))) AS i FROM blocks)
),
again AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS nth FROM keyed) WHERE nth > 1
),
marked AS (
  SELECT doc_id, p, coalesce(p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 100, FALSE) AS goes_on FROM again
),
numbered AS (
  SELECT doc_id, p, sum((NOT goes_on)::INTEGER) OVER (PARTITION BY doc_id ORDER BY p ROWS UNBOUNDED PRECEDING) AS span FROM marked
),
spans AS (SELECT doc_id, span, min(p) AS a, max(p) + 100 AS b FROM numbered GROUP BY doc_id, span),
pieces AS (
  SELECT s.doc_id, s.a, s.b, lag(s.b, 1, 0) OVER (PARTITION BY s.doc_id ORDER BY s.a) AS since FROM spans s
),
cut AS (
  SELECT q.doc_id, sum(q.b - q.a)::BIGINT AS removed, count(*) AS n_spans, max(q.b) AS until,
    string_agg(substr(d.h, 2 * q.since + 1, 2 * (q.a - q.since)), '' ORDER BY q.a) AS head
  FROM pieces q JOIN docs d USING (doc_id) GROUP BY q.doc_id
)
SELECT d.doc_id, d.n AS n_bytes, coalesce(c.removed, 0) AS n_removed, coalesce(c.n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN c.removed IS NULL THEN d.h ELSE c.head || substr(d.h, 2 * c.until + 1) END)) AS kept_sha256
FROM docs d LEFT JOIN cut c USING (doc_id)
"""

#: the CRC-32 of the id's digits is formed bit by bit
_TRIE = r"""
WITH told AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS r
  FROM conversations WHERE conv_id IS NOT NULL
),
own AS (SELECT c, list(struct_pack(role, text) ORDER BY r) AS turns FROM told GROUP BY c),
heads AS (
  SELECT c, turns, (xor(4294967295, list_reduce(
    [4294967295::BIGINT] || list_transform(range(1, strlen(c::VARCHAR) + 1), lambda i: ascii(substr(c::VARCHAR, i, 1))::BIGINT),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda bits, _: xor(bits >> 1, 3988292384 * (bits & 1))))) % 4)::BIGINT AS h
  FROM own
),
rebuilt AS (
  SELECT o.c, list_concat(CASE WHEN b.turns IS NULL THEN [] ELSE b.turns[1:o.h] END, o.turns[o.h + 1:]) AS turns
  FROM heads o LEFT JOIN own b ON b.c = o.c - o.c % 20
),
begun AS (
  SELECT c, turns[1:d] AS prefix, d, len(turns) = d AS ends, turns[d].text AS text
  FROM (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
),
nodes AS (
  SELECT prefix, d, min(c) AS low, count(*) AS n_convs,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '') AS ended,
    CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(any_value(text), '[^\x20\x09-\x0D]+')) END AS words
  FROM begun GROUP BY prefix, d
),
children AS (SELECT prefix[1:d - 1] AS prefix, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
known AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN children k USING (prefix)),
subtrees AS (
  SELECT prefix[1:a] AS prefix, sum((n_children = 0)::BIGINT) AS n_leaves, sum((n_convs - 1) * words) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM known) GROUP BY ALL
)
SELECT k.low AS conv_id, k.d AS depth, p.low AS parent_conv_id, k.n_convs, k.n_children,
  s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(k.ended) AS ends_sha256
FROM known k JOIN subtrees s USING (prefix) LEFT JOIN nodes p ON k.d > 0 AND p.prefix = k.prefix[1:k.d - 1]
"""

ORACLES: dict[str, str] = {
    "op1_line_templates": _LINES,
    "op6_embedding_links": _LINKS,
    "op2_minhash_groups": _MINHASH,
    "op3_source_mix": _MIXING,
    "op5_url_verdicts": _URLS,
    "op7_warc_records": _WARC,
    "op11_repeated_bytes": _REPEATS,
    "op13_conversation_trie": _TRIE,
}
