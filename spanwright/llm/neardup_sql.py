"""DuckDB SQL that gives near_duplicates() of table documents by brute force."""

NEAR_DUPLICATES = r"""
WITH RECURSIVE
words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
numbered AS (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM words),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM numbered),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c >= 75 * (p.n + q.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT a AS doc_id, a AS other FROM both_ways
  UNION SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON r.other = l.a),
roots AS (SELECT doc_id, min(other) AS root FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, coalesce(r.root, d.doc_id) AS component_id,
       coalesce(r.root, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN roots r USING (doc_id)
"""
