"""Queries on chunking: conversations stand for documents of several pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import chunking, token_chunking
from ..operators.chunking import Limits
from .registry import Registry
from .standins import table

REGISTRY = Registry()
query = REGISTRY.query

#: Smaller limits than the defaults, so that the test texts are cut.
SMALL = Limits(target=1000, overlap=100, most=4000, least=150, section_least=200, pages=3)
NL2 = "chr(10) || chr(10)"


def _place(what: str) -> str:
    """0-based place of the last occurrence in the window w, or -1."""
    return f"(CASE WHEN contains(w, {what}) THEN length(w) - strpos(reverse(w), reverse({what})) - length({what}) + 1 ELSE -1 END)"


SENTENCE = f"greatest({_place("'. '")}, {_place("'.' || chr(10)")}, {_place("'? '")}, {_place("'! '")})"
TRIM = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"


def split_sql(source: str) -> str:
    """CTEs: cut (id, p, x) are the parts of source (id, t) whose trimmed text is longer than SMALL.most, by the recursion that the cuts follow."""
    return f"""body AS (SELECT id, t, length(t) n FROM (SELECT id, {TRIM.format('t')} t FROM {source})),
c AS (SELECT id, t, n, CAST(0 AS BIGINT) p, CAST(-1 AS BIGINT) e FROM body WHERE n > 4000
  UNION ALL SELECT id, t, n, np, CASE WHEN np + 1000 >= n THEN n WHEN b > 500 THEN np + b + 2 WHEN s > 333 THEN np + s + 2 ELSE np + 1000 END
  FROM (SELECT id, t, n, np, {_place(NL2)} b, {SENTENCE} s FROM (SELECT id, t, n, np, substr(t, np + 1, 1000) w FROM (SELECT id, t, n, CASE WHEN e < 0 THEN 0 ELSE greatest(p + 1, e - 100) END np FROM c WHERE e < n) q) q2) q3),
cut AS (SELECT id, p, {TRIM.format('substr(t, p + 1, e - p)')} x FROM c WHERE e >= 0)"""


@query(f"""WITH RECURSIVE d AS (SELECT doc_id id, text t FROM documents), {split_sql('d')},
seg AS (SELECT id doc_id, p, x FROM cut UNION ALL SELECT id, 0, t FROM body WHERE n <= 4000),
k AS (SELECT doc_id, x, row_number() OVER (PARTITION BY doc_id ORDER BY p) - 1 i, count(*) OVER (PARTITION BY doc_id) total FROM seg WHERE length(x) >= 150)
SELECT doc_id, CAST(i AS INTEGER) chunk_index, CAST(total AS INTEGER) chunk_total, sha256(CAST(doc_id AS VARCHAR) || '::chunk::' || printf('%06d', i)) chunk_id, sha256(x) text_hash FROM k""")
def sliding_window(spark, sf_dir):
    got = chunking.sliding_window(table(spark, sf_dir, "documents"), "doc_id", "text", SMALL)
    return got.select("doc_id", "chunk_index", "chunk_total", "chunk_id", F.sha2("chunk_text", 256).alias("text_hash"))


def _pages(spark, sf_dir):
    """Turns as pages: some blank, some failed, every fifth with a heading."""
    turn = F.col("turn")
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("doc_id"), (turn + 1).cast("int").alias("page"), (F.pmod("conv_id", F.lit(7)) == turn).alias("is_blank"), F.when(F.pmod("conv_id", F.lit(9)) == turn, "bad").alias("error"),
        "text", F.array(F.col("role")).alias("content_types"), F.when(F.pmod(turn, F.lit(5)) == 0, F.concat(F.lit("Part "), F.floor(turn / 10).cast("string"))).alias("heading"),
    )


PAGES = """pages AS (SELECT CAST(conv_id AS VARCHAR) doc_id, CAST(turn + 1 AS INTEGER) page, conv_id % 7 = turn is_blank, CASE WHEN conv_id % 9 = turn THEN 'bad' END error, text, role,
  CASE WHEN turn % 5 = 0 THEN 'Part ' || CAST(turn // 10 AS VARCHAR) END heading FROM conversations), good AS (SELECT * FROM pages WHERE NOT is_blank AND error IS NULL)"""
GROUPS = """g0 AS (SELECT *, coalesce(last_value(heading IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY page ROWS UNBOUNDED PRECEDING), '') title FROM good),
g1 AS (SELECT *, CASE WHEN title <> lag(title) OVER (PARTITION BY doc_id ORDER BY page) THEN 1 ELSE 0 END fresh FROM g0), g2 AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY page ROWS UNBOUNDED PRECEDING) run FROM g1),
g AS (SELECT doc_id, page, title, CAST(run AS BIGINT) run, CAST((row_number() OVER (PARTITION BY doc_id, run ORDER BY page) - 1) // 3 AS INTEGER) block FROM g2)"""


@query(f"WITH {PAGES}, {GROUPS} SELECT * FROM g")
def page_groups(spark, sf_dir):
    return chunking.page_groups(_pages(spark, sf_dir), SMALL).select("doc_id", "page", "title", "run", "block")


def _contents(spark, sf_dir):
    """Every third page starts an entry."""
    turns = table(spark, sf_dir, "conversations").where(F.pmod("turn", F.lit(3)) == 1)
    return turns.select(F.col("conv_id").cast("string").alias("doc_id"), F.col("turn").alias("position"), F.concat(F.lit("Entry "), F.col("turn").cast("string")).alias("title"), (F.col("turn") + 1).cast("int").alias("page"))


RANGES = """toc AS (SELECT CAST(conv_id AS VARCHAR) doc_id, turn AS position, 'Entry ' || turn title, CAST(turn + 1 AS INTEGER) page FROM conversations WHERE turn % 3 = 1),
n AS (SELECT CAST(conv_id AS VARCHAR) doc_id, CAST(max(turn) + 1 AS INTEGER) page_count FROM conversations GROUP BY 1),
r AS (SELECT doc_id, position, title, page AS s, least(coalesce(lead(page) OVER (PARTITION BY doc_id ORDER BY position) - 1, page_count), page_count) AS e FROM toc JOIN n USING (doc_id))"""


@query(f"WITH {PAGES}, {RANGES} SELECT p.doc_id, page, title, s AS \"start\", e AS \"end\" FROM good p JOIN r ON p.doc_id = r.doc_id AND page BETWEEN s AND e")
def toc_sections(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    counts = pages.groupBy("doc_id").agg(F.max("page").alias("page_count"))
    ranges = chunking.section_ranges(_contents(spark, sf_dir), counts)
    return chunking.in_sections(chunking.usable(pages), ranges).select("doc_id", "page", "title", "start", "end")


@query(f"WITH {PAGES}, {GROUPS} SELECT doc_id, run, block, list_sort(list_distinct(list(role))) content_types, min(page) page_start, max(page) page_end FROM good JOIN g USING (doc_id, page) GROUP BY 1, 2, 3")
def content_types(spark, sf_dir):
    groups = chunking._grouped(chunking.page_groups(_pages(spark, sf_dir), SMALL), ["doc_id", "run", "block"])
    return groups.select("doc_id", "run", "block", "content_types", "page_start", "page_end")


CHUNKS = f"""{PAGES}, {GROUPS}, {RANGES}, listed AS (SELECT doc_id FROM toc GROUP BY 1 HAVING count(*) >= 3),
m AS (SELECT 'section' kind, p.doc_id, position AS x, 0 y, title, page, text, role, s, e FROM good p JOIN r ON p.doc_id = r.doc_id AND page BETWEEN s AND e WHERE p.doc_id IN (SELECT doc_id FROM listed)
  UNION ALL SELECT 'page', doc_id, run, block, title, page, text, role, NULL, NULL FROM good JOIN g USING (doc_id, page) WHERE doc_id NOT IN (SELECT doc_id FROM listed)),
u AS (SELECT *, row_number() OVER (PARTITION BY kind, doc_id, x, y, key ORDER BY page) nth FROM (SELECT *, lower({TRIM.format("regexp_replace(text, '\\s+', ' ', 'g')")}) key FROM m)),
w AS (SELECT kind, doc_id, x, y, title, {TRIM.format("coalesce(string_agg(text, chr(10) || chr(10) ORDER BY page) FILTER (nth = 1 AND key <> ''), '')")} t, list_sort(list_distinct(list(role))) types, min(page) p0, max(page) p1, min(s) s, min(e) e FROM u GROUP BY 1, 2, 3, 4, 5),
named AS (SELECT * EXCLUDE (t), CASE WHEN title = '' OR starts_with(lower(t), lower(title)) THEN t ELSE title || {NL2} || t END t FROM w),
kept AS (SELECT row_number() OVER (ORDER BY kind, doc_id, x, y) id, * FROM named WHERE length(t) >= CASE kind WHEN 'section' THEN 200 ELSE 150 END),
{split_sql('kept')},
parts AS (SELECT id, 0 p, t AS txt, kind lvl FROM kept WHERE length(t) <= 4000 UNION ALL SELECT id, p, x, 'split' FROM cut WHERE length(x) >= 150),
fin AS (SELECT doc_id, lvl, title, types, CASE WHEN kind = 'section' AND length(t) <= 4000 THEN s ELSE p0 END p0, CASE WHEN kind = 'section' AND length(t) <= 4000 THEN e ELSE p1 END p1, {TRIM.format('txt')} txt, x, y, p FROM parts JOIN kept USING (id)),
num AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY x, y, p) - 1 i, count(*) OVER (PARTITION BY doc_id) total FROM fin WHERE length(txt) >= 150)"""


@query(f"""WITH RECURSIVE {CHUNKS} SELECT sha256(doc_id || '::chunk::' || printf('%06d', i)) chunk_id, doc_id, CAST(i AS INTEGER) chunk_index, CAST(total AS INTEGER) chunk_total, lvl chunk_level, title section_title,
  CAST(p0 AS INTEGER) page_start, CAST(p1 AS INTEGER) page_end, types content_types, txt chunk_text FROM num""")
def chunk_documents(spark, sf_dir):
    return chunking.chunk_documents(_pages(spark, sf_dir), _contents(spark, sf_dir), SMALL)


@query(f"WITH RECURSIVE {CHUNKS} SELECT lvl chunk_level, count(*) n FROM num GROUP BY 1 ORDER BY 1")
def chunk_levels(spark, sf_dir):
    return chunking.level_summary(chunk_documents(spark, sf_dir))


@query(f"""WITH {PAGES} SELECT page, count(*) n FROM good GROUP BY 1 ORDER BY 1 LIMIT 20""")
def chunks_per_page(spark, sf_dir):
    return chunking.usable(_pages(spark, sf_dir)).groupBy("page").agg(F.count(F.lit(1)).alias("n")).orderBy("page").limit(20)


#: Line breaks of a text are one unit's, as no line of these texts is a heading or blank; a table is a unit as it is.
TOKEN_POLICY = token_chunking.Policy(max_tokens=200, min_tokens=50, overlap_tokens=20)
TOKEN = r"'[\p{L}\p{M}\p{N}_]+\s*|[^\p{L}\p{M}\p{N}_\s]\s*|\s+'"


@query(rf"""WITH RECURSIVE u AS (SELECT CAST(conv_id AS VARCHAR) doc_id, turn, role, CASE WHEN role = 'user' THEN array_to_string(list_transform(string_split({TRIM.format('text')}, chr(10)), lambda l: {TRIM.format('l')}), ' ') ELSE {TRIM.format('text')} END t
  FROM conversations WHERE conv_id % 7 <> turn),
words AS (SELECT *, regexp_extract_all(t, '\S+\s*') w, len(regexp_extract_all(t, {TOKEN})) n FROM u WHERE t <> ''),
fill AS (SELECT doc_id, turn, role, w, CAST(1 AS BIGINT) a, CAST(1 AS BIGINT) b FROM words WHERE n > 196
  UNION ALL SELECT doc_id, turn, role, w, b, b + greatest(1, len(list_filter(range(b, len(w) + 1), lambda k: len(regexp_extract_all(array_to_string(w[b:k], ''), {TOKEN})) <= 196))) FROM fill WHERE b <= len(w)),
part AS (SELECT doc_id, turn, role, 0 a, t FROM words WHERE n <= 196 UNION ALL SELECT doc_id, turn, role, a, {TRIM.format("array_to_string(w[a:b - 1], '')")} FROM fill WHERE b > a),
tok AS (SELECT *, regexp_extract_all(t, {TOKEN}) k FROM part),
doc AS (SELECT doc_id, list(t ORDER BY turn, a) t, list(k ORDER BY turn, a) k, list(turn + 1 ORDER BY turn, a) page, list(CASE WHEN role = 'user' THEN 'text' ELSE 'table' END ORDER BY turn, a) kind FROM tok GROUP BY 1),
sums AS (SELECT *, list_transform(range(0, len(t) + 1), lambda j: coalesce(list_sum(list_transform(k[1:j], lambda x: len(x))), 0)) c FROM doc),
ch AS (SELECT *, CAST(1 AS BIGINT) i, CAST(1 AS BIGINT) j, '' carry, CAST(-1 AS BIGINT) nth FROM sums
  UNION ALL SELECT doc_id, t, k, page, kind, c, j, z, CASE WHEN z > j AND z <= len(t) AND least(20, len(k[z - 1])) + len(k[z]) <= 200 THEN array_to_string(k[z - 1][greatest(1, len(k[z - 1]) - 19):], '') ELSE '' END, nth + 1
  FROM (SELECT *, j + len(list_filter(range(j, len(t) + 1), lambda q: c[q + 1] - c[j] + len(regexp_extract_all(carry, {TOKEN})) <= 200)) z FROM ch WHERE j <= len(t)) q),
rows_ AS (SELECT *, lag(carry) OVER (PARTITION BY doc_id ORDER BY nth) before FROM ch)
SELECT sha256(doc_id || '::chunk::' || printf('%06d', nth)) chunk_id, doc_id, CAST(nth AS INTEGER) chunk_index, CAST(max(nth) OVER (PARTITION BY doc_id) + 1 AS INTEGER) chunk_total, 'page' chunk_level, '' section_title,
  CAST(page[CASE WHEN before <> '' THEN i - 1 ELSE i END] AS INTEGER) page_start, CAST(page[j - 1] AS INTEGER) page_end, list_sort(list_distinct(kind[CASE WHEN before <> '' THEN i - 1 ELSE i END:j - 1])) content_types,
  CASE WHEN before <> '' THEN before || chr(10) ELSE '' END || array_to_string(t[i:j - 1], chr(10)) chunk_text FROM rows_ WHERE nth >= 0""")
def token_chunks(spark, sf_dir):
    element = lambda p: F.array(F.struct(F.when(p["role"] == "user", "text").otherwise("table").alias("kind"), p["text"].alias("text")))
    pages = F.transform(F.sort_array(F.collect_list(F.struct("turn", "text", "role", "blank"))), lambda p: F.struct((p["turn"] + 1).cast("int").alias("page"), element(p).alias("elements"), p["blank"].alias("is_blank")))
    turns = table(spark, sf_dir, "conversations").withColumn("blank", F.pmod("conv_id", F.lit(7)) == F.col("turn"))
    rows = turns.groupBy(F.col("conv_id").cast("string").alias("doc_id")).agg(pages.alias("pages"))
    return token_chunking.chunk_documents(rows.withColumn("contents", F.array().cast("array<struct<level:int,title:string,page:int>>")), TOKEN_POLICY).drop("headers", "error")
