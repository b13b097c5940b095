"""Answers in SQL for DuckDB, where SQL can express an operator."""

from __future__ import annotations

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
phrases AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n,
    array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
places AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM phrases) WHERE len(w) >= n)),
found AS (SELECT r, i, n, item_id FROM places JOIN phrases USING (n, phrase)),
hit AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM found)) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(joined, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

_PLAIN_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"
)

JACCARD = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, {_PLAIN_WORDS} AS w FROM documents),
s AS (
  SELECT DISTINCT r, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
both_in AS (
  SELECT a.r AS x, b.r AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r < b.r GROUP BY 1, 2),
links AS (
  SELECT x, y FROM both_in JOIN n a ON a.r = x JOIN n b ON b.r = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(x, y) AS (SELECT r, r FROM d UNION SELECT reach.x, edges.y FROM reach JOIN edges ON reach.y = edges.x),
least_id AS (SELECT x AS r, min(doc_id) AS component_id FROM reach JOIN d ON d.r = y GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM d LEFT JOIN n USING (r) JOIN least_id USING (r)
"""

MIXING = """
WITH d AS (
  SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    -ln((CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' ||
      md5(coalesce(text, ''))), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0) AS drawn
  FROM documents),
w AS (
  SELECT doc_id, max(CASE WHEN quality > 0 THEN 2.0 ELSE 0.5 END) AS weight
  FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
k AS (SELECT d.doc_id, source, size, drawn / CAST(coalesce(weight, 1.0) AS DOUBLE) AS key FROM d LEFT JOIN w USING (doc_id)),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
n AS (
  SELECT *, 2 * source_size AS most,
    [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM s),
l AS (
  SELECT *, sum(source_size) OVER () * 1.5 - coalesce(sum(most) OVER before, 0) AS unspent,
    sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS free FROM n
  WINDOW before AS (ORDER BY CAST(most AS DOUBLE) / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, unspent * weight >= most * free AS is_full FROM l),
level AS (SELECT max_by(unspent, free) AS unspent, max(free) AS free FROM f WHERE NOT is_full),
t AS (
  SELECT source, source_size, CASE WHEN is_full THEN CAST(most AS DOUBLE)
    ELSE least(CAST(f.weight AS DOUBLE) * CAST(level.unspent AS DOUBLE) / CAST(level.free AS DOUBLE), CAST(most AS DOUBLE)) END AS target
  FROM f, level),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes FROM t),
o AS (
  SELECT k.doc_id, size, p.source_size, target, passes,
    CAST(round(target - passes * p.source_size) AS BIGINT) AS rest,
    CAST(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS BIGINT) AS ahead
  FROM k JOIN p ON k.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
  CAST(passes * size + least(size, greatest(rest - ahead, 0)) AS BIGINT) AS taken FROM o
"""
