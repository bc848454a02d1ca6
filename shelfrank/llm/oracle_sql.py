"""DuckDB twins of the queries that SQL can express on whole tables."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP6 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)]
                                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle
  FROM words WHERE ws IS NOT NULL),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c ON c.doc_id = d.doc_id
"""

OP3 = f"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all({_LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, unnest([array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ')
         FOR i IN range(1, len(ws) - least(len(ws), 10) + 2)]) AS w
  FROM item_words WHERE len(ws) > 0),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, unnest(range(1, len(ws) - n + 2)) AS i, ws FROM doc_words, lengths WHERE len(ws) >= n),
found AS (
  SELECT p.doc_id, p.i, p.n, w.item_id FROM places p JOIN windows w ON w.n = p.n AND w.w = array_to_string(p.ws[p.i:p.i + p.n - 1], ' ')),
hit AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS word FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM found GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(d.ws), 0) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit h ON h.doc_id = d.doc_id LEFT JOIN items i ON i.doc_id = d.doc_id
"""

# Links are the absolute ones of double-quoted attributes, which is all that SQL can read here.
OP5 = f"""
WITH RECURSIVE rules(h, p, action) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
links AS (
  SELECT url AS a, coalesce(nullif(regexp_extract(html, '<link[^>]*rel="canonical"[^>]*href="([^"]*)"', 1), ''),
                            nullif(regexp_extract(html, '<link[^>]*href="([^"]*)"[^>]*rel="canonical"', 1), '')) AS b FROM pages),
urls AS (SELECT DISTINCT url FROM (SELECT url FROM pages UNION ALL SELECT b FROM links) WHERE url IS NOT NULL),
parsed AS (
  SELECT url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM urls),
places AS (
  SELECT url, {_LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parsed),
own AS (
  SELECT url, max_by(h || p, length(h || p)) AS rule, max_by(action, length(h || p)) AS action
  FROM places JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY url),
nodes AS (SELECT url, regexp_replace(url, '#.*$', '') AS node FROM urls),
edges AS (
  SELECT x.node AS a, y.node AS b FROM links JOIN nodes x ON x.url = links.a JOIN nodes y ON y.url = links.b WHERE x.node <> y.node),
reach AS (
  SELECT DISTINCT node, node AS other FROM nodes
  UNION SELECT reach.node, e.b FROM reach JOIN (SELECT a, b FROM edges UNION SELECT b, a FROM edges) e ON e.a = reach.other),
shared AS (
  SELECT r.node, CASE WHEN bool_or(o.action = 'allow') THEN 'allow' ELSE 'block' END AS action
  FROM reach r JOIN nodes n ON n.node = r.other JOIN own o ON o.url = n.url WHERE r.node IN (SELECT a FROM edges UNION SELECT b FROM edges) GROUP BY r.node)
SELECT p.page_id, coalesce(l.host, '') AS host, coalesce(l.path, '') AS path, o.rule, coalesce(o.action, s.action, 'allow') AS verdict
FROM pages p LEFT JOIN places l ON l.url = p.url LEFT JOIN own o ON o.url = p.url
LEFT JOIN nodes n ON n.url = p.url LEFT JOIN shared s ON s.node = n.node
"""

# The same with redirects from each page but every fourth to the one before.
URL_ALIASES = OP5.replace("urls AS (", """more AS (
  SELECT a, b FROM links UNION ALL SELECT p.url, q.url FROM pages p JOIN pages q ON q.page_id = p.page_id - 1 WHERE p.page_id % 4 <> 0),
urls AS (""").replace("SELECT b FROM links)", "SELECT b FROM more)").replace("FROM links JOIN nodes x ON x.url = links.a JOIN nodes y ON y.url = links.b", "FROM more JOIN nodes x ON x.url = more.a JOIN nodes y ON y.url = more.b")

OP7 = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT payload_digest, min(page_id) AS first FROM payloads WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM payloads p LEFT JOIN firsts f ON f.payload_digest = p.payload_digest
"""

OP11 = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM usable a JOIN usable r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
negatives AS (
  SELECT p.anchor_id, p.positive_id, s.other_id AS negative_id, p.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INTEGER AS rank
  FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
  WHERE 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 3
"""

OP12 = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces),
totals AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM words, range(1, 6) sizes(k) WHERE len(ws) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
  SELECT lang, phrase, f AS a, c AS cut, array_to_string(ws[1:c], ' ') AS first, array_to_string(ws[c + 1:], ' ') AS rest
  FROM (SELECT lang, phrase, f, string_split(phrase, ' ') AS ws, unnest(range(1, k)) AS c FROM f WHERE k > 1)),
scored AS (
  SELECT c.lang, c.phrase, a, cut, x.f AS l, y.f AS r, n, ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.first JOIN f y ON y.lang = c.lang AND y.phrase = c.rest JOIN totals t ON t.lang = c.lang),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
left_over AS (
  SELECT * FROM lowest p WHERE NOT EXISTS (
    SELECT 1 FROM f q WHERE q.lang = p.lang AND 100 * q.f >= 100 * p.a AND len(q.phrase) > len(p.phrase) AND contains(' ' || q.phrase || ' ', ' ' || p.phrase || ' '))),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM left_over)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op3_decontaminate": OP3,
    "op5_url_filter": OP5,
    "url_aliases": URL_ALIASES,
    "op6_near_duplicates": OP6,
    "op7_warc": OP7,
    "op11_hard_negatives": OP11,
    "op12_collocations": OP12,
}
