"""SQL that the queries are compared with, where SQL can express them."""

from __future__ import annotations

#: Water-filling as plain SQL: ordered by room per unit of weight, the sources that stop come first.
OP7 = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('20:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 13))::BIGINT::DOUBLE
           / 4503599627370496 AS drawn
  FROM documents),
sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS most,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM docs GROUP BY source),
ordered AS (
  SELECT *, row_number() OVER w AS place,
         sum(source_size) OVER () - coalesce(sum(most) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
         sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
  FROM sizes WINDOW w AS (ORDER BY most::DOUBLE / weight, source NULLS LAST)),
level AS (
  SELECT place AS first, lft AS first_left, weight_left AS first_weight FROM ordered
  WHERE lft::DOUBLE / weight_left <= most::DOUBLE / weight ORDER BY place LIMIT 1),
rates AS (
  SELECT source, source_size, least(most::DOUBLE,
         CASE WHEN place < first THEN most::DOUBLE ELSE (weight * first_left)::DOUBLE / first_weight END) AS target
  FROM ordered, level)
SELECT doc_id, size, source_size, target, size * (floor(rate)::BIGINT + (drawn < rate - floor(rate))::BIGINT) AS taken
FROM (SELECT d.*, r.source_size, r.target, coalesce(r.target / nullif(r.source_size, 0), 0) AS rate
      FROM docs d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source)
"""

#: Exact distinct sites for every line, where the query sketches them first.
OP4 = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, text, source FROM documents),
sites AS (SELECT text, coalesce('=' || min(source), 'null') AS site FROM docs WHERE text IS NOT NULL GROUP BY text),
lines AS (
  SELECT r, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS place
  FROM docs WHERE text IS NOT NULL),
keyed AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS k FROM lines),
spread AS (SELECT k FROM keyed JOIN sites USING (text) WHERE k <> '' GROUP BY k HAVING count(DISTINCT site) >= 8),
marked AS (SELECT r, place, line, k IN (SELECT k FROM spread) AS gone FROM keyed),
judged AS (
  SELECT r, count(*) FILTER (gone) AS n, string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone) AS kept FROM marked GROUP BY r)
SELECT doc_id, coalesce(n, 0)::INTEGER AS removed_lines, CASE WHEN n > 0 THEN coalesce(kept, '') ELSE text END AS text
FROM docs LEFT JOIN judged USING (r)
"""

_WHOLE = r"""
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda c: floor(256 * c::DOUBLE))::DOUBLE[] AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
"""

#: All anchors against all rows.
OP11 = rf"""
WITH whole AS ({_WHOLE}),
v AS (SELECT r, vec_id, x, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM whole WHERE label IS NOT NULL),
scored AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, c.r AS c, c.vec_id, c.label = a.label AS same, list_inner_product(a.x, c.x)::BIGINT AS score
  FROM v a JOIN v c ON len(a.x) = len(c.x) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT a, anchor_id, c, vec_id AS positive_id, score AS positive_score FROM scored WHERE same AND a <> c
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, c) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER w AS rank, n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.a = n.a AND NOT n.same AND 80 * positive_score <= 100 * n.score AND n.score <= positive_score
WINDOW w AS (PARTITION BY p.a, p.c ORDER BY n.score DESC, n.vec_id, n.c)
QUALIFY row_number() OVER w <= 5
"""

#: All queries against all rows.
OP13 = rf"""
WITH v AS ({_WHOLE})
SELECT q.vec_id AS query_id, row_number() OVER w AS rank, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
FROM v q JOIN v c ON q.r <> c.r AND len(q.x) = len(c.x) WHERE q.vec_id % 50 = 0
WINDOW w AS (PARTITION BY q.r ORDER BY list_inner_product(q.x, c.x) DESC, c.vec_id)
QUALIFY row_number() OVER w <= 5
"""

ORACLES: dict[str, str] = {
    "op4_line_dedup": OP4,
    "op7_mixing": OP7,
    "op11_hard_negatives": OP11,
    "op13_pivot_search": OP13,
}
