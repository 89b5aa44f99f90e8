"""Queries on tables and layout: lineitem's rows stand for cells and boxes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import layout, regions, tables
from ..sources import pdf, store
from .registry import Registry
from .standins import table

REGISTRY = Registry()
query = REGISTRY.query


def _cells(spark, sf_dir):
    """A table for each customer nation: orders as rows of four cells, some of them blank."""
    c = table(spark, sf_dir, "customer")
    row = F.array(F.col("c_custkey").cast("string"), F.when(F.pmod("c_custkey", F.lit(3)) == 0, "").otherwise(F.col("c_mktsegment")), F.col("c_name"), F.when(F.pmod("c_custkey", F.lit(5)) == 0, None).otherwise(F.concat("c_mktsegment", F.lit("|x"))))
    head = F.array(*(F.lit(x) for x in ("Id", "Segment", "Name", "Note")))
    grouped = c.groupBy("c_nationkey").agg(F.transform(F.sort_array(F.collect_list(F.struct("c_custkey", row.alias("r")))), lambda x: x["r"]).alias("rows"))
    return grouped.select(F.col("c_nationkey").alias("table_id"), F.concat(F.array(head), "rows").alias("cells"))


CELLS = """k AS (SELECT c_nationkey table_id, c_custkey, CAST(c_custkey AS VARCHAR) a, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END b, c_name c, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_mktsegment || '|x' END d FROM customer
  UNION ALL SELECT DISTINCT c_nationkey, -1, 'Id', 'Segment', 'Name', 'Note' FROM customer),
f AS (SELECT table_id, c_custkey, a, coalesce(last_value(nullif(b, '') IGNORE NULLS) OVER w, '') b, c, coalesce(last_value(nullif(d, '') IGNORE NULLS) OVER w, '') d FROM k WINDOW w AS (PARTITION BY table_id ORDER BY c_custkey ROWS UNBOUNDED PRECEDING))"""
WIDTHS = "w AS (SELECT table_id, " + ", ".join(f"CAST(greatest(3, max(length({c}))) AS INTEGER) w{c}" for c in "abcd") + " FROM f GROUP BY 1)"
LINE = "'| ' || " + " || ' | ' || ".join(f"rpad({c}, w{c}, ' ')" for c in "abcd") + " || ' |'"
RULE = "'|' || " + " || '|' || ".join(f"repeat('-', w{c} + 2)" for c in "abcd") + " || '|'"


@query(f"WITH {CELLS}, {WIDTHS} SELECT table_id, string_agg(CASE WHEN c_custkey = -1 THEN {LINE} || chr(10) || {RULE} ELSE {LINE} END, chr(10) ORDER BY c_custkey) markdown, CAST(count(*) AS INTEGER) row_count, TRUE has_header FROM f JOIN w USING (table_id) GROUP BY 1")
def table_markdown(spark, sf_dir):
    return tables.process_tables(_cells(spark, sf_dir)).select("table_id", "markdown", "row_count", "has_header")


@query(f"WITH {CELLS} SELECT table_id, string_agg('Id: ' || a || CASE WHEN b = '' THEN '' ELSE ' | Segment: ' || b END || ' | Name: ' || c || CASE WHEN d = '' THEN '' ELSE ' | Note: ' || d END, chr(10) ORDER BY c_custkey) plain_text FROM f WHERE c_custkey >= 0 GROUP BY 1")
def table_plain_text(spark, sf_dir):
    return tables.process_tables(_cells(spark, sf_dir)).select("table_id", "plain_text")


@query("""WITH k AS (SELECT c_nationkey, c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END seg FROM customer)
SELECT c_nationkey, c_custkey, coalesce(last_value(nullif(seg, '') IGNORE NULLS) OVER (PARTITION BY c_nationkey ORDER BY c_custkey ROWS UNBOUNDED PRECEDING), '') seg FROM k""")
def forward_fill_cells(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", F.when(F.pmod("c_custkey", F.lit(3)) == 0, "").otherwise(F.col("c_mktsegment")).alias("seg"))
    return tables.forward_fill(rows, "c_nationkey", "c_custkey", ["seg"])


def _boxes(spark, sf_dir):
    """An order is a page, its lines are boxes."""
    x, y = F.pmod("l_partkey", F.lit(500)).cast("double"), F.pmod("l_suppkey", F.lit(97)).cast("double") * 8
    part = F.col("l_partkey").cast("string")
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"), F.min("l_suppkey").alias("l_suppkey"), F.min("l_quantity").alias("q"), F.min("l_returnflag").alias("l_returnflag"))
    return rows.select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("id"), x.alias("x0"), y.alias("y0"), (x + F.col("q") * 4).alias("x1"), (y + 30).alias("y1"), (F.col("l_returnflag") == "R").alias("is_image"), F.concat(part, F.lit(" of "), part).alias("text"))


BOXES = """l AS (SELECT l_orderkey, l_linenumber, min(l_partkey) pk, min(l_suppkey) sk, min(l_quantity) q, min(l_returnflag) rf FROM lineitem GROUP BY 1, 2),
boxes AS (SELECT l_orderkey page, l_linenumber id, CAST(pk % 500 AS DOUBLE) x0, CAST(sk % 97 * 8 AS DOUBLE) y0, pk % 500 + q * 4 x1, sk % 97 * 8 + 30.0::DOUBLE y1, rf = 'R' is_image, pk || ' of ' || pk AS text FROM l)"""
PAIRS = """pairs AS (SELECT a.page, a.id left_id, b.id right_id, greatest(0, least(a.x1 + 20, b.x1) - greatest(a.x0 - 20, b.x0)) * greatest(0, least(a.y1 + 20, b.y1) - greatest(a.y0 - 20, b.y0)) / nullif(least(greatest(0, a.x1 - a.x0 + 40) * greatest(0, a.y1 - a.y0 + 40), greatest(0, b.x1 - b.x0) * greatest(0, b.y1 - b.y0)), 0) share
  FROM boxes a JOIN boxes b ON a.page = b.page WHERE a.is_image AND NOT b.is_image)"""


@query(f"WITH {BOXES}, {PAIRS} SELECT page, left_id, right_id, round(share, 6) share FROM pairs WHERE share > 0.01".replace("a.x0", "a.x0"))
def bbox_overlap_pairs(spark, sf_dir):
    rows = _boxes(spark, sf_dir)
    # the grown box has the margin on all sides, also in its area
    grown = rows.where("is_image").select("page", "id", (F.col("x0") - 20).alias("x0"), (F.col("y0") - 20).alias("y0"), (F.col("x1") + 20).alias("x1"), (F.col("y1") + 20).alias("y1"))
    return layout.overlapping(grown, rows.where("not is_image"), ["page"]).select("page", "left_id", "right_id", F.round("share", 6).alias("share"))


@query(f"WITH {BOXES}, {PAIRS} SELECT i.page, i.id, coalesce(n, 0) >= 2 is_chart FROM boxes i LEFT JOIN (SELECT page, left_id, count(*) n FROM pairs WHERE share > 0.01 GROUP BY 1, 2) p ON p.page = i.page AND p.left_id = i.id WHERE is_image")
def chart_images(spark, sf_dir):
    rows = _boxes(spark, sf_dir)
    return layout.charts(rows.where("is_image").drop("text"), rows.where("not is_image"), ["page"], 20.0, 3).select("page", "id", "is_chart")


@query("""SELECT o_orderkey page, CASE WHEN o_orderkey % 150 < 100 AND o_orderkey % 3 > 0 THEN 'scanned' WHEN o_orderkey % 150 = 0 AND o_orderkey % 3 = 0 THEN 'blank' ELSE 'native' END kind FROM orders""")
def page_kinds(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("page"), layout.page_kind(F.pmod("o_orderkey", F.lit(150)), F.pmod("o_orderkey", F.lit(3))).alias("kind"))


@query(f"""WITH RECURSIVE {BOXES}, o AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY id) - 1 i, count(*) OVER (PARTITION BY page) n, x0 + x1 < 600 on_left FROM boxes),
p AS (SELECT page, any_value(n) n, count(*) FILTER (on_left) k, list(i ORDER BY round_even(y0 / 5, 0), x0, i) single, coalesce(list({{'i': i, 'y': y0}} ORDER BY y0, x0, i) FILTER (on_left), []) l, coalesce(list({{'i': i, 'y': y0}} ORDER BY y0, x0, i) FILTER (NOT on_left), []) r FROM o GROUP BY 1),
s AS (SELECT page, l, r, CAST(1 AS BIGINT) a, CAST(1 AS BIGINT) b, CAST([] AS BIGINT[]) done FROM p WHERE n >= 4 AND 4 * k > n AND 4 * k < 3 * n
  UNION ALL SELECT page, l, r, a + CAST(gap < 10 AS BIGINT), b + CAST(gap > -10 AS BIGINT), list_concat(list_concat(done, CASE WHEN gap < 10 THEN [l[a].i] ELSE [] END), CASE WHEN gap > -10 THEN [r[b].i] ELSE [] END)
  FROM (SELECT *, CASE WHEN abs(l[a].y - r[b].y) < 10 THEN 0 WHEN l[a].y < r[b].y THEN -99 ELSE 99 END gap FROM s WHERE a <= len(l) AND b <= len(r)) q),
e AS (SELECT page, list_concat(list_concat(done, list_transform(l[a:], lambda x: x.i)), list_transform(r[b:], lambda x: x.i)) places FROM s WHERE a > len(l) OR b > len(r))
SELECT page, array_to_string(places, ',') places FROM e UNION ALL SELECT page, array_to_string(single, ',') FROM p WHERE NOT (n >= 4 AND 4 * k > n AND 4 * k < 3 * n)""")
def reading_order(spark, sf_dir):
    pages = _boxes(spark, sf_dir).groupBy("page").agg(F.sort_array(F.collect_list(F.struct("id", "x0", "y0", "x1", "y1"))).alias("b"))
    boxes = F.transform("b", lambda e: F.struct(*(e[k].alias(k) for k in layout.BOX)))
    return pages.select("page", F.array_join(layout.reading_order(boxes, F.lit(600.0)).cast("array<string>"), ",").alias("places"))


@query("SELECT conv_id doc_id, turn page, string_agg(w, ' ' ORDER BY i) AS text, avg(c) confidence, count(*) word_count, NOT (avg(c) < 0.6 AND count(*) > 5) accepted FROM (SELECT conv_id, turn, unnest(string_split(text, ' ')) w, unnest(range(len(string_split(text, ' ')))) i, CASE WHEN conv_id % 2 = 0 THEN 0.5 ELSE 0.75 END::DOUBLE c FROM conversations) GROUP BY 1, 2")
def ocr_results(spark, sf_dir):
    words = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page"), F.posexplode(F.split("text", " ")).alias("at", "text"), F.when(F.pmod("conv_id", F.lit(2)) == 0, 0.5).otherwise(0.75).alias("confidence"), F.lit("en").alias("language"))
    return layout.ocr_result(words, ["doc_id", "page"]).drop("language")


#: Pages of one made document, and those of a range.
DOCUMENT_PAGES, RANGE_PAGES = 40, 7


@query(f"""WITH p AS (SELECT page_id // {DOCUMENT_PAGES} d, row_number() OVER (PARTITION BY page_id // {DOCUMENT_PAGES} ORDER BY page_id) page, page_id % 17 = 3 bad, replace(coalesce(html, ''), chr(12), ' ') t FROM pages),
l AS (SELECT d, page, bad, unnest(string_split(t, chr(10))) line FROM p)
SELECT 'doc-' || d doc_id, CAST(page AS INTEGER) page, count(*) FILTER (NOT bad AND trim(line, ' ' || chr(9) || chr(13)) <> '') n_elements, coalesce(sum(length(line)) FILTER (NOT bad AND trim(line, ' ' || chr(9) || chr(13)) <> ''), 0)::BIGINT n_chars, any_value(CASE WHEN bad THEN 'page ' || page || ' cannot be read' END) error FROM l GROUP BY 1, 2
HAVING bool_or(bad) OR count(*) FILTER (trim(line, ' ' || chr(9) || chr(13)) <> '') > 0""")
def page_ranges(spark, sf_dir):
    """Documents of many pages, written as files of a plain format and read back by ranges of pages: a page that fails is a row."""
    rows = table(spark, sf_dir, "pages").select(F.concat(F.lit("doc-"), F.floor(F.col("page_id") / DOCUMENT_PAGES).cast("string")).alias("doc_id"), "page_id", F.concat(F.when(F.pmod("page_id", F.lit(17)) == 3, F.lit("\0")).otherwise(""), F.replace(F.coalesce("html", F.lit("")), F.lit("\f"), F.lit(" "))).alias("t"))
    whole = rows.groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page_id", "t"))), lambda x: x["t"]), "\f").alias("text"))  # at most DOCUMENT_PAGES pages
    files = store.written_files(whole.select("doc_id", F.encode("text", "utf-8").alias("content")), "documents")
    parsed = pdf.parse_ranges(files, pdf.TextPages(), RANGE_PAGES).where("kind = 'text' or error is not null")
    return parsed.groupBy("doc_id", "page").agg(F.count("kind").alias("n_elements"), F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("long").alias("n_chars"), F.max("error").alias("error"))


def _table_boxes(spark, sf_dir):
    """A page for each nation: a title, then a row of four columns for each customer, of boxes a word each; some
    cells are missing, and every fifth customer's second cell has another line below."""
    c = table(spark, sf_dir, "customer")
    rows = c.select("c_nationkey", "c_custkey", "c_mktsegment", "c_name", (F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")) * 26.0 + 100).alias("y"))
    word = lambda x, dy, text: F.struct((F.lit(x) if isinstance(x, int) else x).cast("double").alias("x"), F.lit(float(dy)).alias("dy"), text.alias("t"))
    key = F.col("c_custkey")
    words = F.array(word(10, 0, key.cast("string")), word(110, 1, F.col("c_mktsegment")), word(114 + 6 * F.length("c_mktsegment"), 0, F.lit("x")), F.when(key % 3 != 0, word(250, 0, F.col("c_name"))), word(420, 2, F.lit("note")), word(452, 1, (key % 7).cast("string")), F.when(key % 5 == 0, word(112, 13, F.lit("goes on"))))
    boxes = rows.select("c_nationkey", "y", F.explode(F.array_compact(words)).alias("w")).select("c_nationkey", (F.col("y") + F.col("w.dy")).alias("y0"), F.col("w.x").alias("x0"), F.col("w.t").alias("text"))
    title = c.select("c_nationkey").distinct().select("c_nationkey", F.lit(40.0).alias("y0"), F.lit(10.0).alias("x0"), F.lit("A title over the table").alias("text"))
    every = boxes.unionByName(title).withColumn("id", F.row_number().over(Window.partitionBy("c_nationkey").orderBy(F.xxhash64("y0", "x0"))))
    return every.select(F.lit("d").alias("doc_id"), F.col("c_nationkey").alias("page"), "id", "x0", "y0", (F.col("x0") + 6 * F.length("text")).alias("x1"), (F.col("y0") + 10).alias("y1"), "text")


@query("""WITH r AS (SELECT c_nationkey page, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS "row", c_custkey k, c_mktsegment s, c_name n, count(*) OVER (PARTITION BY c_nationkey) many FROM customer),
c AS (SELECT page, "row", unnest([0, 1, 2, 3]) AS "column", unnest([CAST(k AS VARCHAR), s || ' x' || CASE WHEN k % 5 = 0 THEN ' goes on' ELSE '' END, CASE WHEN k % 3 <> 0 THEN n END, 'note ' || k % 7]) AS text FROM r WHERE many > 2)
SELECT page, CAST("row" AS INTEGER) AS "row", "column", text FROM c WHERE text IS NOT NULL""")
def table_regions(spark, sf_dir):
    found = regions.table_cells(_table_boxes(spark, sf_dir))
    return found.select("page", "row", "column", "text")
