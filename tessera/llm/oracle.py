"""DuckDB SQL for the queries that SQL can express, on the same tables."""

from __future__ import annotations

from tessera.llm.licenses import TEMPLATES, THRESHOLD

# Nearest neighbours by brute force.
OP9 = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_cosine_similarity(q.e, c.e) AS score
  FROM v q JOIN v c ON len(q.e) = len(c.e) AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT * FROM (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM s) WHERE rank <= 5
"""

# Water filling in closed form, then the Pareto order by running sums.
OP6 = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    (CAST('0x' || substr(md5('1729|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')), 1, 13) AS BIGINT) + 0.5)::DOUBLE
      / CAST(4503599627370496 AS DOUBLE) AS u
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST(([3, 1, 2])[(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS DOUBLE) AS weight,
             2.0::DOUBLE * source_size AS most FROM s),
k AS (SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM s)
                 - coalesce(sum(most) OVER (ORDER BY most / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (ORDER BY most / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS per FROM w),
l AS (SELECT arg_min(per, {'a': most / weight, 's': source}) AS per FROM k WHERE weight * per <= most),
t AS (SELECT source, source_size, least(weight * l.per, most) AS target FROM w, l),
g AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio FROM t),
h AS (SELECT *, CAST(floor(ratio) AS BIGINT) AS copies FROM g),
r AS (
  SELECT d.*, h.source_size, h.target, h.copies, h.target - h.copies * h.source_size AS due,
    least(CASE WHEN h.source_size > 0 THEN (ratio - copies) * h.source_size / h.source_size ELSE 0 END, 1 - 1e-9) AS p
  FROM d JOIN h ON d.source IS NOT DISTINCT FROM h.source),
q AS (SELECT *, CASE WHEN due > 0 AND p > 0 THEN ((u / (1 - u)) / (p / (1 - p))) END AS odds FROM r),
o AS (SELECT *, odds / (1 + odds) AS v FROM q),
c AS (SELECT *, sum(size) OVER (PARTITION BY source, v IS NULL ORDER BY v, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM o),
f AS (SELECT *, v IS NOT NULL AND upto <= due AS fits FROM c),
x AS (SELECT source, due, coalesce(sum(size) FILTER (fits), 0) AS got FROM f GROUP BY source, due),
b AS (
  SELECT f.source, arg_min(f.doc_id, {'a': abs(f.size - (x.due - x.got)), 'v': f.v, 'd': f.doc_id}) AS doc_id
  FROM f JOIN x ON f.source IS NOT DISTINCT FROM x.source
  WHERE f.v IS NOT NULL AND NOT fits AND abs(f.size - (x.due - x.got)) < x.due - x.got GROUP BY f.source)
SELECT f.doc_id, f.size, f.source_size, f.target,
  CAST(f.size * (f.copies + CASE WHEN f.fits OR b.doc_id IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM f LEFT JOIN b ON f.source IS NOT DISTINCT FROM b.source AND f.doc_id = b.doc_id
"""

# Links from shared shingles, components by reachability.
OP5 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
g AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] ELSE
    list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g FROM w),
n AS (SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles FROM g),
s AS (SELECT doc_id, unnest(g) AS sh FROM g),
e AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY 1, 2) p
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 75 * (na.n_shingles + nb.n_shingles - k)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM n UNION SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a),
c AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT n.doc_id, n_shingles, component_id, n.doc_id = component_id AS kept FROM n JOIN c ON n.doc_id = c.doc_id
"""

# Windows of 100 bytes as 200 hexadecimal digits.
OP10 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, unnest(range(0, greatest(len(x) // 2 - 99, 0))) AS p, x FROM d),
h AS (SELECT doc_id, p, md5(substr(x, 2 * p + 1, 200)) AS k FROM w),
f AS (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY k) AS first_doc, min(p) OVER (PARTITION BY k, doc_id) AS first_p FROM h),
m AS (SELECT doc_id, p, max(p + 100) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
      FROM f WHERE doc_id > first_doc OR p > first_p),
i AS (SELECT doc_id, p, sum(CASE WHEN reach IS NULL OR p > reach THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM m),
r AS (SELECT doc_id, run, min(p) AS a, max(p) + 100 AS b FROM i GROUP BY doc_id, run),
k AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z FROM r),
t AS (
  SELECT d.doc_id, len(any_value(d.x)) // 2 AS n_bytes, coalesce(sum(k.b - k.a), 0) AS n_removed, count(k.a) AS n_spans,
    coalesce(string_agg(substr(d.x, 2 * k.z + 1, 2 * (k.a - k.z)), '' ORDER BY k.a), '')
      || substr(any_value(d.x), 2 * coalesce(max(k.b), 0) + 1) AS kept
  FROM d LEFT JOIN k ON d.doc_id = k.doc_id GROUP BY d.doc_id)
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed, CAST(n_spans AS BIGINT) AS n_spans,
  sha256(unhex(kept)) AS kept_sha256 FROM t
"""

_ROWS = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(TEMPLATES))

OP2 = rf"""
WITH tpl(turn, name, txt) AS (VALUES {_ROWS}),
tt AS (SELECT turn, name, term, count(*) AS c FROM (
         SELECT turn, name, unnest(string_split_regex(lower(txt), '[^a-z0-9]+')) AS term FROM tpl) WHERE term <> '' GROUP BY ALL),
d AS (SELECT row_number() OVER () AS row, doc_id, lower(text) AS txt,
        concat(coalesce(source, 'unknown'), '/', doc_id // 10000, '/', doc_id // 100, '/', doc_id, '.txt') AS path FROM documents),
n AS (SELECT count(*) AS n FROM d),
seen AS (SELECT term, count(DISTINCT row) AS df FROM (SELECT row, unnest(string_split_regex(txt, '[^a-z0-9]+')) AS term FROM d)
         WHERE term IN (SELECT term FROM tt) GROUP BY term),
wt AS (SELECT v.term, ln((1 + n) / (1 + coalesce(df, 0))::DOUBLE) + 1 AS x FROM (SELECT DISTINCT term FROM tt) v CROSS JOIN n
       LEFT JOIN seen ON v.term = seen.term),
tv AS (SELECT turn, name, tt.term, c * x / sqrt(sum(c * x * c * x) OVER (PARTITION BY turn)) AS x FROM tt JOIN wt ON tt.term = wt.term),
ln1 AS (SELECT row, unnest(string_split(txt, chr(10))) AS line FROM d),
lines AS (SELECT row, row_number() OVER () AS line_no, line FROM ln1 WHERE line IS NOT NULL),
lt AS (SELECT row, line_no, term, count(*) AS c FROM (
         SELECT row, line_no, unnest(string_split_regex(line, '[^a-z0-9]+')) AS term FROM lines) WHERE term <> '' GROUP BY ALL),
lx AS (SELECT row, line_no, lt.term, c * coalesce(x, (SELECT ln((1 + n) / 2.0::DOUBLE) + 1 FROM n)) AS x
       FROM lt LEFT JOIN wt ON lt.term = wt.term),
size AS (SELECT line_no, sqrt(sum(x * x)) AS size FROM lx GROUP BY line_no),
sc AS (SELECT lx.row, lx.line_no, tv.turn, tv.name, round(sum(lx.x * tv.x) / any_value(size.size), 6) AS score
       FROM lx JOIN tv ON lx.term = tv.term JOIN size ON lx.line_no = size.line_no GROUP BY ALL),
own AS (SELECT row, name AS own, score FROM sc WHERE score >= {THRESHOLD}
        QUALIFY row_number() OVER (PARTITION BY row ORDER BY score DESC, turn) = 1),
f AS (SELECT d.row, doc_id, path, regexp_extract(path, '^(.*)/', 1) AS folder, own, score FROM d LEFT JOIN own ON d.row = own.row),
decl AS (SELECT folder, arg_min(own, doc_id) AS licence FROM f WHERE own IS NOT NULL GROUP BY folder),
near AS (
  SELECT f.folder, arg_max(decl.folder, len(decl.folder)) AS dir, arg_max(decl.licence, len(decl.folder)) AS licence
  FROM (SELECT DISTINCT folder FROM f) f JOIN decl ON f.folder = decl.folder OR starts_with(f.folder, decl.folder || '/') GROUP BY f.folder)
SELECT doc_id, path, own, coalesce(score, 0.0)::DOUBLE AS score, coalesce(own, licence) AS licence,
  CASE WHEN own IS NULL THEN near.dir END AS origin
FROM f LEFT JOIN near ON f.folder = near.folder
"""

# Every document scored for every item.
OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
p AS (SELECT row, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM d GROUP BY row, term),
l AS (SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM p GROUP BY row),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM l),
w AS (SELECT term, CAST(floor(1000 * ln((2 * s.docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM p, s GROUP BY term, s.docs),
q AS (SELECT item_id, term, count(*) AS c FROM (SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
x AS (SELECT q.item_id, p.row, p.doc_id,
        CAST(sum(q.c * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (25 + (75 * l.n * s.docs) // s.total)))) AS BIGINT) AS score
      FROM q JOIN w ON q.term = w.term JOIN p ON p.term = q.term JOIN l ON l.row = p.row, s GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM x WHERE score > 0 QUALIFY rank <= 10
"""

# All inner products of the anchors.
OP13 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM v a JOIN v c ON len(a.v) = len(c.v) AND a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

ORACLE = {
    "op2_license_scan": OP2,
    "op5_minhash_neardup": OP5,
    "op6_mixing": OP6,
    "op9_one_bit_neighbours": OP9,
    "op10_suffix_dedup": OP10,
    "op12_ranked_search": OP12,
    "op13_hard_negatives": OP13,
}
