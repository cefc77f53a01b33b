"""The same results in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op10_winnowing"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS g FROM (
    SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS p FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS g FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p
    FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hit AS (SELECT doc_id, p, n, item_id FROM dw JOIN bw USING (n, g)),
cov AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (
    SELECT DISTINCT doc_id, unnest(range(p, p + n)) AS q FROM hit) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS s FROM (
    SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(s, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""

ORACLE_SQL["op5_count_rtree"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + least(len(w), 3) - 1], ' ') AS g FROM (
    SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), 3) + 2)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
-- Copies meet through their first document, so a common shingle makes few pairs.
whole AS (SELECT doc_id, md5(string_agg(g, '|' ORDER BY g)) AS h FROM s GROUP BY 1),
rep AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS r FROM whole),
u AS (SELECT s.doc_id, g, n FROM s JOIN rep ON rep.doc_id = s.doc_id AND rep.r = rep.doc_id JOIN n ON n.doc_id = s.doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c, any_value(a.n) AS nx, any_value(b.n) AS ny
  FROM u a JOIN u b ON a.g = b.g AND a.doc_id < b.doc_id AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n) GROUP BY 1, 2),
links AS (
  SELECT x, y FROM pairs WHERE 100 * c >= 90 * (nx + ny - c)
  UNION SELECT doc_id, r FROM rep WHERE doc_id <> r),
e AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM n UNION SELECT reach.doc_id, e.y FROM reach JOIN e ON e.x = reach.other),
comp AS (SELECT doc_id, min(other) AS c FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN comp USING (doc_id)
"""

ORACLE_SQL["op12_blocked_products"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT row_number() OVER () AS q, item_id, list_distinct(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM benchmark),
s AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0),
it AS (SELECT q, item_id, unnest(w) AS term FROM i),
dt AS (
  SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM it) GROUP BY r, term),
f AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
  FROM dt, s GROUP BY term),
p AS (
  SELECT r, term, (1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(w)::BIGINT * n_docs) // l)) AS impact
  FROM dt JOIN d USING (r), s),
scored AS (
  SELECT q, any_value(item_id) AS item_id, r, sum(weight * impact)::BIGINT AS score
  FROM it JOIN f USING (term) JOIN p USING (term) GROUP BY q, r),
ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scored JOIN d USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""

ORACLE_SQL["op13_prefix_targets"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place,
    count(*) OVER (PARTITION BY conv_id) AS n
  FROM (
    SELECT conv_id, turn, role, text FROM conversations UNION ALL
    SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL
    SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (
  SELECT *, length(regexp_replace(text, '([<\[])(\\*)(/?s>|</?SYS>>|/?INST\]|/?TURN\]|:\])', '\1\\\2\3', 'g')) + CASE role
      WHEN 'system' THEN 17 WHEN 'user' THEN 15 WHEN 'assistant' THEN 6
      ELSE 19 + length(regexp_replace(role, '([<\[])(\\*)(/?s>|</?SYS>>|/?INST\]|/?TURN\]|:\])', '\1\\\2\3', 'g')) END AS size
  FROM c),
p AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY place) + 3 AS so_far FROM e)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(so_far) FILTER (role = 'assistant' OR place = n)::BIGINT AS formatted_chars
FROM p GROUP BY conv_id
"""
