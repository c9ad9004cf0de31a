"""DuckDB SQL for the queries of this folder that SQL can express."""

OP1 = r"""
WITH w AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         (CAST(CAST(('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12)) AS BIGINT) AS DOUBLE) + 0.5) / 281474976710656.0::DOUBLE AS u
  FROM documents),
t AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM w GROUP BY source),
n AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rn FROM t),
c AS (SELECT source, source_size, rn, CAST(CASE (rn - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS BIGINT) AS weight, source_size * 2 AS cap FROM n),
l AS (SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS rest,
             CAST(sum(weight) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS open_weight,
             row_number() OVER (ORDER BY CAST(cap AS DOUBLE) / weight, rn) AS k
      FROM c),
h AS (SELECT rest, open_weight FROM l WHERE rest / open_weight <= CAST(cap AS DOUBLE) / weight ORDER BY k LIMIT 1),
g AS (SELECT l.source, l.source_size, l.rn,
             least(coalesce(l.weight * (SELECT rest FROM h) / (SELECT open_weight FROM h), CAST(l.cap AS DOUBLE)), CAST(l.cap AS DOUBLE)) AS target FROM l),
o AS (SELECT w.doc_id, w.size, w.u, g.rn, g.source_size, g.target, CASE WHEN w.size >= 1000 THEN 3 WHEN w.size >= 100 THEN 2 ELSE 1 END AS m
      FROM w JOIN g ON w.source IS NOT DISTINCT FROM g.source),
v0 AS (SELECT rn, any_value(target) AS target, CASE WHEN sum(size * m) > 0 THEN any_value(target) / CAST(sum(size * m) AS DOUBLE) ELSE 0.0::DOUBLE END AS level FROM o GROUP BY rn),
v1 AS (SELECT v0.rn, v0.target, CASE WHEN sum(CASE WHEN m * level < 2 THEN size * m ELSE 0 END) > 0
          THEN (v0.target - 2 * CAST(sum(CASE WHEN m * level >= 2 THEN size ELSE 0 END) AS DOUBLE)) / CAST(sum(CASE WHEN m * level < 2 THEN size * m ELSE 0 END) AS DOUBLE) ELSE level END AS level
       FROM v0 JOIN o ON o.rn = v0.rn GROUP BY v0.rn, v0.target, level),
v2 AS (SELECT v1.rn, v1.target, CASE WHEN sum(CASE WHEN m * level < 2 THEN size * m ELSE 0 END) > 0
          THEN (v1.target - 2 * CAST(sum(CASE WHEN m * level >= 2 THEN size ELSE 0 END) AS DOUBLE)) / CAST(sum(CASE WHEN m * level < 2 THEN size * m ELSE 0 END) AS DOUBLE) ELSE level END AS level
       FROM v1 JOIN o ON o.rn = v1.rn GROUP BY v1.rn, v1.target, level),
v3 AS (SELECT v2.rn, v2.target, CASE WHEN sum(CASE WHEN m * level < 2 THEN size * m ELSE 0 END) > 0
          THEN (v2.target - 2 * CAST(sum(CASE WHEN m * level >= 2 THEN size ELSE 0 END) AS DOUBLE)) / CAST(sum(CASE WHEN m * level < 2 THEN size * m ELSE 0 END) AS DOUBLE) ELSE level END AS level
       FROM v2 JOIN o ON o.rn = v2.rn GROUP BY v2.rn, v2.target, level),
e AS (SELECT o.doc_id, o.size, o.u, o.rn, o.source_size, o.target, least(2.0::DOUBLE, o.m * v3.level) AS expected FROM o JOIN v3 ON v3.rn = o.rn),
p AS (SELECT *, CAST(floor(expected) AS BIGINT) AS whole, expected - floor(expected) AS pi FROM e),
q AS (SELECT *, CASE WHEN pi > 0 THEN u / (1 - u) / (pi / (1 - pi)) END AS score,
             CAST(floor(target) AS BIGINT) - CAST(sum(whole * size) OVER (PARTITION BY rn) AS BIGINT) AS budget FROM p),
s AS (SELECT *, CAST(sum(CASE WHEN pi > 0 THEN size ELSE 0 END) OVER (PARTITION BY rn ORDER BY score, doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM q)
SELECT doc_id, size, source_size, target,
       CAST(whole * size + CASE WHEN pi > 0 THEN greatest(least(size, budget - (upto - size)), 0) ELSE 0 END AS BIGINT) AS taken
FROM s
"""

OP6 = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, list_extract(ws, i) || ' ' || list_extract(ws, i + 1) AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws))) AS i FROM w WHERE len(ws) > 1) x
  UNION ALL SELECT doc_id, list_extract(ws, 1) FROM w WHERE len(ws) = 1),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
k AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
l AS MATERIALIZED (SELECT x, y FROM k UNION ALL SELECT y, x FROM k),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.y FROM r JOIN l ON l.x = r.b),
m AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d JOIN m ON m.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

OP8 = r"""
WITH h AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
w AS (SELECT doc_id, p, substr(x, 2 * p + 1, 200) AS s FROM (SELECT doc_id, x, unnest(range(0, n - 99)) AS p FROM h WHERE n >= 100) t),
f AS MATERIALIZED (SELECT s, min(doc_id) AS d0 FROM w GROUP BY s HAVING count(*) > 1),
g AS (SELECT w.doc_id, w.p, row_number() OVER (PARTITION BY w.s ORDER BY w.doc_id, w.p) AS k FROM w JOIN f ON f.s = w.s),
i AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run
      FROM (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS fresh FROM g WHERE k > 1) t),
r AS MATERIALIZED (SELECT doc_id, run, min(p) AS a, max(p) + 100 AS b FROM i GROUP BY doc_id, run),
c AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM r
      UNION ALL SELECT h.doc_id, coalesce(max(r.b), 0), any_value(h.n) FROM h LEFT JOIN r ON r.doc_id = h.doc_id GROUP BY h.doc_id),
t AS (SELECT c.doc_id, string_agg(substr(h.x, 2 * c.a + 1, 2 * (c.b - c.a)), '' ORDER BY c.a) AS x FROM c JOIN h ON h.doc_id = c.doc_id GROUP BY c.doc_id),
z AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM r GROUP BY doc_id)
SELECT h.doc_id, h.n AS n_bytes, coalesce(z.n_removed, 0) AS n_removed, coalesce(z.n_spans, 0) AS n_spans, sha256(unhex(t.x)) AS kept_sha256
FROM h JOIN t ON t.doc_id = h.doc_id LEFT JOIN z ON z.doc_id = h.doc_id
"""
