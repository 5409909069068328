"""DuckDB SQL for the queries that SQL can express."""

WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

#: Budgets by water filling over sources, then one threshold in hash order for each source.
OP1 = rf"""
WITH docs AS (
  SELECT doc_id, source, CAST({WORDS} AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce('=' || CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS h
  FROM documents),
sized AS (SELECT source, CAST(sum(size) AS BIGINT) AS s FROM docs GROUP BY source),
ranked AS (
  SELECT source, s, ([3.0, 1.0, 2.0])[1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3]::DOUBLE AS w,
         row_number() OVER (ORDER BY source IS NULL, source) AS n
  FROM sized),
rated AS (
  SELECT *, 2.0::DOUBLE * s AS cap, 2.0::DOUBLE * s / w AS rate,
         sum(s) OVER () AS total, sum(w) OVER () AS all_w,
         sum(s) OVER o - s AS s_before, sum(w) OVER o - w AS w_before
  FROM ranked WINDOW o AS (ORDER BY 2.0::DOUBLE * s / w, n ROWS UNBOUNDED PRECEDING)),
levels AS (
  SELECT *, (1.5::DOUBLE * total - 2.0::DOUBLE * s_before) / (all_w * 1000000 - w_before * 1000000) * 1000000 AS lv FROM rated),
free AS (SELECT min_by(lv, (rate, n)) AS lv FROM levels WHERE rate > lv),
goal AS (
  SELECT source, s, least(cap, CASE WHEN s = 0 THEN 0 ELSE coalesce((SELECT lv FROM free), 'inf'::DOUBLE) * w END)::DOUBLE AS target
  FROM levels),
part AS (
  SELECT *, CASE WHEN s > 0 THEN CAST(floor(target / s) AS BIGINT) ELSE 0 END AS base FROM goal),
runs AS (
  SELECT source, h, sum(size) AS size FROM docs GROUP BY source, h),
cut AS (
  SELECT source, h, sum(size) OVER (PARTITION BY source ORDER BY h ROWS UNBOUNDED PRECEDING) AS upto, size FROM runs)
SELECT d.doc_id, d.source, d.size, p.s AS source_size, p.target,
       CAST(d.size * (p.base + CASE WHEN c.upto + (c.upto - c.size) <= 2 * (p.target - p.base * p.s) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM docs d
JOIN part p ON d.source IS NOT DISTINCT FROM p.source
JOIN cut c ON d.source IS NOT DISTINCT FROM c.source AND d.h = c.h
"""

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TOKENS = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Every run of item words of a window's length, joined as text with the runs of the same length in documents.
OP4 = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TOKENS} AS w FROM documents),
items AS (SELECT item_id, {_TOKENS} AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(8, len(w)) AS m, array_to_string(w[i : i + least(8, len(w)) - 1], ' ') AS gram
  FROM items, unnest(range(1, len(w) - least(8, len(w)) + 2)) t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT m FROM wins),
grams AS (
  SELECT r, m, i, array_to_string(w[i : i + m - 1], ' ') AS gram
  FROM docs, sizes, unnest(range(1, len(w) - m + 2)) t(i) WHERE len(w) >= m),
hits AS (SELECT g.r, g.m, g.i, x.item_id FROM grams g JOIN wins x USING (m, gram)),
spread AS (SELECT r, count(DISTINCT i + k) AS n FROM hits, unnest(range(0, m)) t(k) GROUP BY r),
found AS (
  SELECT r, count(DISTINCT item_id) AS n, array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS ids
  FROM hits WHERE item_id IS NOT NULL GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(s.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(f.n, 0) AS BIGINT) AS n_items, sha256(coalesce(f.ids, '')) AS items_sha256,
       coalesce(f.n, 0) >= 2 AS contaminated
FROM docs d LEFT JOIN spread s USING (r) LEFT JOIN found f USING (r)
"""


#: All pairs of one label, and everything that links reach.
OP3 = """
WITH RECURSIVE vectors AS (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
good AS (
  SELECT *, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM vectors
  WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.r AS a, b.r AS b FROM good a JOIN good b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93),
reach(a, b) AS (SELECT r, r FROM vectors UNION SELECT x.a, l.b FROM reach x JOIN links l ON x.b = l.a),
least AS (SELECT x.a, min(v.vec_id) AS component_id FROM reach x JOIN vectors v ON x.b = v.r GROUP BY x.a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, l.component_id, coalesce(v.vec_id = l.component_id, false) AS kept
FROM vectors v JOIN least l ON l.a = v.r LEFT JOIN counts c ON c.a = v.r
"""


#: Documents that hold each long key; what isn't in the largest of enough of them goes.
OP12 = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (
  SELECT r, doc_id, i, lines[i] AS line,
         translate(trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM docs, unnest(range(1, len(lines) + 1)) t(i)),
often AS (
  SELECT key, max(doc_id) AS owner FROM lines WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), 'null')) >= 5),
marked AS (
  SELECT l.*, o.key IS NOT NULL AND l.doc_id IS DISTINCT FROM o.owner AS gone FROM lines l LEFT JOIN often o ON l.key = o.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r
"""

_ROUND = """
d{n} AS (
  SELECT v.r, c.c, sum((v.x - c.x) * (v.x - c.x)) AS far FROM parts v JOIN c{n} c USING (dim) GROUP BY v.r, c.c),
a{n} AS MATERIALIZED (SELECT r, min_by(c, (far, c)) AS c, min(far) AS far FROM d{n} GROUP BY r)"""
_MOVE = """
m{n} AS (
  SELECT a.c, v.dim, sum(v.x) AS s, count(*) AS n FROM a{n} a JOIN parts v USING (r) GROUP BY a.c, v.dim),
c{next} AS MATERIALIZED (
  SELECT c.c, c.dim, CAST(CASE WHEN m.n IS NULL THEN c.x ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS HUGEINT) AS x
  FROM c{n} c LEFT JOIN m{n} m ON m.c = c.c AND m.dim = c.dim)"""

#: Every distance, round by round.
OP13 = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
parts AS MATERIALIZED (
  SELECT r, dim, CAST(floor(64 * CAST(embedding[dim] AS DOUBLE)) AS HUGEINT) AS x FROM kept, unnest(range(1, 65)) t(dim)),
first AS (
  SELECT r, row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)) NULLS LAST) - 1 AS c FROM kept),
c0 AS MATERIALIZED (SELECT f.c, v.dim, v.x FROM first f JOIN parts v USING (r) WHERE f.c < 16),
{",".join(_ROUND.format(n=n) + "," + _MOVE.format(n=n, next=n + 1) for n in range(3))},{_ROUND.format(n=3)},
about AS (SELECT c, sum(far) AS s FROM a3 GROUP BY c),
named AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY dim)) AS digest FROM c3 GROUP BY c)
SELECT k.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.far AS BIGINT) AS distance, CAST(o.s AS BIGINT) AS cluster_inertia,
       CAST((SELECT sum(s) FROM about) AS BIGINT) AS inertia, n.digest AS centroid_sha256
FROM a3 a JOIN kept k USING (r) JOIN about o ON o.c = a.c JOIN named n ON n.c = a.c
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": OP1, "op3_embeddings": OP3, "op4_decontamination": OP4, "op12_lines": OP12, "op13_centroids": OP13}
