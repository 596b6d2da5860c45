"""DuckDB SQL of the registered corpus queries that SQL can express."""

OP1 = r"""
WITH d AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    1.0::DOUBLE / (1.0::DOUBLE + 20.0::DOUBLE * (length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#*$%&|<>', '')))::DOUBLE
        / greatest(length(coalesce(text, '')), 1)::DOUBLE) AS weight,
    ((('0x' || substr(md5(coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) || ':mix-1'), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
  FROM documents),
k AS (SELECT *, -ln(u) / weight AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk FROM s),
w AS (SELECT *, CASE rk % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w FROM r),
q AS (SELECT *, 2 * source_size AS full_size, (2 * source_size)::DOUBLE / w AS ratio FROM w),
l AS (SELECT *,
    ((sum(source_size) OVER ())::DOUBLE * 3 / 2
      - coalesce(sum(full_size) OVER (ORDER BY ratio, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / (sum(w) OVER (ORDER BY ratio, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM q),
v AS (SELECT arg_min(level, ratio * 1000000 + rk) AS level FROM l WHERE level <= ratio),
t AS (SELECT q.source, q.source_size, least(full_size::DOUBLE, coalesce(v.level * w, full_size::DOUBLE)) AS target FROM q, v),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM t),
p AS (SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs, e.target - (e.epochs * e.source_size)::DOUBLE AS rest,
    coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source),
c AS (SELECT *, least(epochs + CASE WHEN rest > 0 AND (2 * before + size)::DOUBLE <= 2 * rest THEN 1 ELSE 0 END, 2) AS n FROM p)
SELECT doc_id, size, source_size, target, (n * size)::BIGINT AS taken, n::BIGINT AS copies FROM c
"""

OP10 = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
o AS (SELECT doc_id, i, line, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i) - 1 AS stop FROM l),
s AS (SELECT *, stop - length(line) AS start FROM o),
-- every run of lines of at least 120 characters, the shortest from its first line
r AS (SELECT a.doc_id, a.i, b.i - a.i + 1 AS n, a.start, b.stop FROM s a ASOF JOIN s b ON a.doc_id = b.doc_id AND a.start + 120 <= b.stop),
t AS (SELECT r.doc_id, r.i, r.n, substr(d.text, (r.start + 1)::BIGINT, (r.stop - r.start)::BIGINT) AS body FROM r JOIN documents d USING (doc_id)),
f AS (SELECT doc_id, i, n, row_number() OVER (PARTITION BY body ORDER BY doc_id, i) > 1 AS again FROM t),
-- a line goes if a run that occurs earlier covers it
c AS (SELECT s.doc_id, s.i, s.line,
    coalesce(max(CASE WHEN f.again THEN f.i + f.n END) OVER (PARTITION BY s.doc_id ORDER BY s.i), 0) > s.i AS gone
  FROM s LEFT JOIN f ON f.doc_id = s.doc_id AND f.i = s.i),
g AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS removed_lines,
    coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS left_text FROM c GROUP BY doc_id)
SELECT d.doc_id, coalesce(g.n_lines, 0) AS n_lines, coalesce(g.removed_lines, 0) AS removed_lines,
  CASE WHEN g.removed_lines > 0 THEN g.left_text ELSE d.text END AS text
FROM documents d LEFT JOIN g USING (doc_id)
"""

OP12 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
s AS (SELECT count(*) FILTER (WHERE len(words) > 0) AS n_docs, greatest(sum(len(words)), 1)::BIGINT AS n_terms FROM d),
p AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(words) AS n, unnest(words) AS term FROM d) GROUP BY ALL),
q AS (
  SELECT item_id, term, count(*) AS reps FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM p WHERE term IN (SELECT term FROM q) GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM f, s),
g AS (SELECT q.item_id, p.doc_id, sum(q.reps * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (25 + (75 * p.n * n_docs) // n_terms))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN p USING (term), s GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM g WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 10
"""
