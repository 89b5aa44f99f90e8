"""SQL for the operators whose whole result it can state: each works from the definition, on all rows.

The others are learned models, encodings of libraries, files, hashes that are
drawn at random, or packings, which SQL does not express; tests/llm holds them
against the libraries, plain versions or exact round trips.
"""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
#: Least reachable id of every node of links (a, b), in both directions, over nodes (id).
CLASSES = """both_ AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT id, id AS r FROM nodes UNION SELECT reach.id, both_.b FROM reach JOIN both_ ON reach.r = both_.a),
classes AS (SELECT id, min(r) AS class FROM reach GROUP BY 1)"""

OP7 = f"""WITH w AS (SELECT doc_id, {WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM w)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS at FROM later),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS at FROM w),
kept AS (SELECT word.doc_id, string_agg(x, ' ' ORDER BY word.at) AS t, count(*) AS n FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.at = gone.at WHERE gone.at IS NULL GROUP BY 1)
SELECT w.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id"""

OP8 = f"""WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
good AS (SELECT * FROM v WHERE v IS NOT NULL AND label IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id < b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
nodes AS (SELECT vec_id AS id FROM embeddings), {CLASSES},
n AS (SELECT a AS id, count(*) AS n FROM both_ GROUP BY 1)
SELECT classes.id AS vec_id, coalesce(n, 0) AS n_links, class AS component_id, classes.id = class AS kept FROM classes LEFT JOIN n ON n.id = classes.id"""

OP10 = f"""WITH RECURSIVE w AS (SELECT doc_id, {WORDS} AS w FROM documents),
shingle AS (SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM w WHERE len(w) > 0)),
bag AS (SELECT doc_id, s, count(*) AS n FROM shingle GROUP BY 1, 2), size AS (SELECT doc_id, sum(n) AS n FROM bag GROUP BY 1),
pair AS (SELECT x.doc_id AS a, y.doc_id AS b, sum(least(x.n, y.n)) AS n FROM bag x JOIN bag y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pair JOIN size p ON a = p.doc_id JOIN size q ON b = q.doc_id WHERE CAST(pair.n AS DOUBLE) / CAST(p.n + q.n - pair.n AS DOUBLE) >= 0.8),
nodes AS (SELECT doc_id AS id FROM documents), {CLASSES}
SELECT id AS doc_id, class AS class_id, id = class AS kept FROM classes"""

#: Two rounds and a last assignment; what a round takes is the entries (p, e, c) before it.
_ASSIGNED = """{to} AS (SELECT id, p, e, d FROM (SELECT id, part.p, e, d, row_number() OVER (PARTITION BY id, part.p ORDER BY d, e) AS r FROM (
SELECT id, part.p, e, list_sum(list_transform(list_zip(part.c, {books}.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM part JOIN {books} ON part.p = {books}.p) AS part) WHERE r = 1)"""
_MOVED = """{to} AS (SELECT {books}.p, {books}.e, coalesce(m.c, {books}.c) AS c FROM {books} LEFT JOIN (
SELECT p, e, list(CAST(floor(CAST(s AS DOUBLE) / n) AS BIGINT) ORDER BY i) AS c FROM (SELECT a.p, a.e, i, sum(c[i]) AS s, count(*) AS n FROM {by} a JOIN part ON a.id = part.id AND a.p = part.p, unnest(range(1, len(c) + 1)) AS t(i) GROUP BY 1, 2, 3) GROUP BY 1, 2) m ON m.p = {books}.p AND m.e = {books}.e)"""
OP12 = f"""WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
whole AS (SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, label, list_transform(v, lambda x: CAST(floor(256 * x) AS BIGINT)) AS q FROM v WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS (SELECT id, p, q[p * len(q) // 16 + 1:(p + 1) * len(q) // 16] AS c FROM whole, unnest(range(0, 16)) AS t(p)),
b0 AS (SELECT p, id - 1 AS e, c FROM part WHERE id <= 64),
{_ASSIGNED.format(to="a0", books="b0")}, {_MOVED.format(to="b1", books="b0", by="a0")},
{_ASSIGNED.format(to="a1", books="b1")}, {_MOVED.format(to="b2", books="b1", by="a1")},
{_ASSIGNED.format(to="a2", books="b2")},
coded AS (SELECT id, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY 1),
books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS s FROM b2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, s AS codebooks_sha256 FROM whole JOIN coded ON whole.id = coded.id, books"""

#: A CRC-32 by its definition, a bit at a time, over the digits of a number.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
lambda a, byte: list_reduce(list_prepend(xor(a, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, zero: xor(x >> 1, 3988292384 * (x & 1)))))"""
OP13 = rf"""WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS x FROM conversations WHERE conv_id IS NOT NULL),
conv AS (SELECT c, c - c % 20 AS b, {_CRC32} % 4 AS h FROM (SELECT DISTINCT c FROM t)),
turns AS (SELECT conv.c, i AS pos, x FROM conv JOIN t ON t.c = b WHERE i <= h UNION ALL SELECT conv.c, 3 + i, x FROM conv JOIN t ON t.c = conv.c WHERE i > h),
seq AS (SELECT conv.c, coalesce(list(x ORDER BY pos) FILTER (x IS NOT NULL), []) AS s FROM conv LEFT JOIN turns ON conv.c = turns.c GROUP BY 1),
prefix AS (SELECT c, d, s[1:d] AS k, len(s) = d AS ends FROM seq, unnest(range(0, len(s) + 1)) AS u(d)),
node AS (SELECT k, d, min(c) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM prefix GROUP BY 1, 2),
child AS (SELECT k[1:d - 1] AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY 1),
whole AS (SELECT node.*, coalesce(n, 0) AS n_children, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(node.k[d].t, '[^\x20\x09-\x0D]+')) END AS saved FROM node LEFT JOIN child ON node.k = child.k),
tree AS (SELECT k[1:up] AS k, sum(saved) AS saved, count(*) FILTER (n_children = 0) AS leaves FROM whole, unnest(range(0, d + 1)) AS u(up) GROUP BY 1)
SELECT whole.conv_id, whole.d AS depth, p.conv_id AS parent_conv_id, whole.n_convs, n_children, leaves AS n_leaves, CAST(tree.saved AS BIGINT) AS saved_tokens, whole.ends_sha256
FROM whole JOIN tree ON whole.k = tree.k LEFT JOIN node p ON p.d = whole.d - 1 AND p.k = whole.k[1:whole.d - 1]"""

ORACLE_SQL: dict[str, str] = {"op7_substring_dedup": OP7, "op8_cap_filters": OP8, "op10_bag_minhash": OP10, "op12_vector_codes": OP12, "op13_prefix_trie": OP13}
