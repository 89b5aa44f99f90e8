"""Chunks of documents by size, by table of contents and by headings.

Pages are rows: doc_id, page, is_blank, error, text (their elements in reading
order), content_types and heading. Contents are rows: doc_id, position, title,
page. Sections and page groups are windows and range joins; only the cut of
one long text into overlapping segments is a fold over that text, which an
Arrow function does for a batch of texts at a time.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import chunk_id, dedup_paragraphs, is_page_heading, strip, with_section


@dataclass(frozen=True)
class Limits:
    target: int = 4000
    overlap: int = 400
    most: int = 24_000
    least: int = 150
    section_least: int = 200
    pages: int = 10
    contents_least: int = 3


#: Rows whose texts a task cuts at a time, and the bytes of these texts beyond which it takes fewer.
ROWS, BYTES = 64, 4 << 20
#: Where a text may be cut, by two signs: at a blank line, or behind a sentence.
PARAGRAPH, SENTENCE = re.compile(r"(?=\n\n)"), re.compile(r"\.\n|[.?!] ")


def cuts(text: str, limits: Limits) -> Iterator[tuple[int, int]]:
    """Overlapping ranges of a text. A range ends with a blank line of its second half, else with
    a sentence of its last two thirds, else at the target."""
    listed = [([m.start() for m in p.finditer(text)], part) for p, part in ((PARAGRAPH, 2), (SENTENCE, 3))]
    start, end = 0, 0
    while end < len(text):
        start = max(start + 1, end - limits.overlap) if end else 0
        end = min(start + limits.target, len(text))
        if end < len(text):
            options = (places[i - 1] + 2 for places, part in listed if (i := bisect_right(places, end - 2)) and places[i - 1] > start + limits.target // part)
            end = next(options, end)
        yield start, end


def segments(text: str, limits: Limits) -> list[str]:
    """A text, or if it is too long its overlapping parts, without those that are too short."""
    text = text.strip()
    ranges = cuts(text, limits) if len(text) > limits.most else [(0, len(text))]
    return [part for a, b in ranges if len(part := text[a:b].strip()) >= limits.least]


def slices(whole: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch whose last column is a text by ROWS rows, or fewer of BYTES in all; a longer text is alone."""
    start, size = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(whole.columns[-1]), 0).to_pylist()):
        if i > start and (i - start == ROWS or size + n > BYTES):
            yield whole.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < whole.num_rows:
        yield whole.slice(start)


def cut_rows(batches: Iterator[pa.RecordBatch], limits: Limits, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of parts for rows whose last column is a text: what stands before it, a part's place, their number and the part."""
    for whole in batches:
        for b in slices(whole):
            *others, texts = b.columns
            parts = [[] if t is None else segments(t, limits) for t in texts.to_pylist()]
            own = pa.array([i for i, p in enumerate(parts) for _ in p], pa.int64())
            places, totals = pa.array([n for p in parts for n in range(len(p))], pa.int32()), pa.array([len(p) for p in parts for _ in p], pa.int32())
            yield pa.RecordBatch.from_arrays([*(c.take(own) for c in others), places, totals, pa.array([x for p in parts for x in p], pa.string())], names=names)


def split_long(rows: DataFrame, text: str, limits: Limits, place: str, total: str) -> DataFrame:
    """Rows for the segments() of each row's text, in its place, with their place (from 0) and their number.

    Parts come out as rows: of an array's explode() Spark infers a condition, which it moves below the
    function where nothing can evaluate it.
    """
    others = [c for c in rows.columns if c != text]
    schema = T.StructType([*(rows.schema[c] for c in others), T.StructField(place, T.IntegerType()), T.StructField(total, T.IntegerType()), T.StructField(text, T.StringType())])
    return rows.select(*others, text).mapInArrow(lambda batches: cut_rows(batches, limits, schema.names), schema)


def sliding_window(docs: DataFrame, key: str, text: str, limits: Limits = Limits()) -> DataFrame:
    """key, chunk_index, chunk_total, chunk_text and chunk_id: short texts stay whole and never leave the JVM."""
    body = strip(F.col(text))
    short = docs.where((F.length(body) <= limits.most) & (F.length(body) >= limits.least)).select(key, F.lit(1).alias("chunk_total"), F.lit(0).alias("chunk_index"), body.alias("chunk_text"))
    long = split_long(docs.where(F.length(body) > limits.most).select(key, F.col(text).alias("chunk_text")), "chunk_text", limits, "chunk_index", "chunk_total")
    out = short.unionByName(long)
    return out.withColumn("chunk_id", chunk_id(F.col(key).cast("string"), F.col("chunk_index")))


def page_text(elements: Column) -> Column:
    """Text of a page from its elements (kind, text) in reading order, tables and figures between marks."""
    shown = F.filter(elements, lambda e: strip(F.coalesce(e["text"], F.lit(""))) != "")
    kind = lambda e: F.upper(e["kind"])
    marked = lambda e: F.concat(F.lit("["), kind(e), F.lit("]\n"), strip(e["text"]), F.lit("\n[/"), kind(e), F.lit("]"))
    return F.array_join(F.transform(shown, lambda e: F.when(e["kind"] == "text", strip(e["text"])).otherwise(marked(e))), "\n")


def page_types(elements: Column) -> Column:
    """Sorted distinct kinds of the elements that have text."""
    shown = F.filter(elements, lambda e: strip(F.coalesce(e["text"], F.lit(""))) != "")
    return F.array_sort(F.array_distinct(F.transform(shown, lambda e: e["kind"])))


def page_heading(elements: Column) -> Column:
    """The first of a page's first five elements that is text and reads as a heading."""
    found = F.filter(F.slice(elements, 1, 5), lambda e: (e["kind"] == "text") & is_page_heading(e["text"]))
    return F.when(F.size(found) > 0, strip(F.element_at(found, F.lit(1))["text"]))


def pages_of(elements: DataFrame) -> DataFrame:
    """Pages from element rows (doc_id, page, ordinal, kind, text)."""
    listed = F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "kind", "text"))), lambda e: F.struct(e["kind"].alias("kind"), e["text"].alias("text")))
    rows = elements.groupBy("doc_id", "page").agg(listed.alias("elements"))
    text = page_text(F.col("elements"))
    return rows.select("doc_id", "page", (text == "").alias("is_blank"), F.lit(None).cast("string").alias("error"), text.alias("text"), page_types(F.col("elements")).alias("content_types"), page_heading(F.col("elements")).alias("heading"))


def usable(pages: DataFrame) -> DataFrame:
    return pages.where(~F.coalesce("is_blank", F.lit(False)) & (F.coalesce("error", F.lit("")) == ""))


def assemble(ordered: Column) -> Column:
    """Pages' texts joined by blank lines, each paragraph once."""
    return strip(dedup_paragraphs(F.array_join(F.filter(ordered, lambda t: t != ""), "\n\n")))


def _grouped(pages: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each group of pages: text, types and the range of pages. A group is bounded by its section."""
    listed = F.sort_array(F.collect_list(F.struct("page", "text", "content_types")))
    rows = pages.groupBy(*keys).agg(listed.alias("p"))
    types = F.array_sort(F.array_distinct(F.flatten(F.transform("p", lambda x: x["content_types"]))))
    return rows.select(*keys, assemble(F.transform("p", lambda x: x["text"])).alias("text"), types.alias("content_types"), F.element_at("p", 1)["page"].alias("page_start"), F.element_at("p", -1)["page"].alias("page_end"))


def section_ranges(contents: DataFrame, page_counts: DataFrame) -> DataFrame:
    """doc_id, position, title, start and end of each entry: up to the page before the next one's.

    Counts travel as rows beside the entries, so each document is sorted once and nothing is joined.
    """
    none = lambda c: F.lit(None).cast(contents.schema[c].dataType).alias(c)
    entries = contents.select("doc_id", "position", "title", "page", F.lit(None).cast("int").alias("page_count"))
    counts = page_counts.select("doc_id", none("position"), none("title"), none("page"), F.col("page_count").cast("int").alias("page_count"))
    document = Window.partitionBy("doc_id")
    in_order = document.orderBy(F.col("page_count").isNotNull(), "position")
    rows = entries.withColumn("entry", F.lit(True)).unionByName(counts.withColumn("entry", F.lit(False)))
    rows = rows.withColumn("next", F.lead("page").over(in_order)).withColumn("page_count", F.max("page_count").over(document)).where("entry and page_count is not null")
    return rows.select("doc_id", "position", "title", F.col("page").alias("start"), F.least(F.coalesce(F.col("next") - 1, F.col("page_count")), F.col("page_count")).alias("end"))


def in_sections(pages: DataFrame, ranges: DataFrame) -> DataFrame:
    """Pages with the entries whose ranges they lie in.

    Pages and ranges of a document are sorted together by page, and each page
    takes the last range before it, so work follows their number and not
    its square. Entries whose pages go back start another run of ranges; a page is
    looked up once in each run of its document (nearly always one).
    """
    document = Window.partitionBy("doc_id")
    back = F.col("start") < F.lag("start").over(document.orderBy("position"))
    own = ranges.withColumn("_run", F.sum(F.when(back, 1).otherwise(0)).over(document.orderBy("position").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    names, columns = [c for c in ranges.columns if c != "doc_id"], [c for c in pages.columns if c != "doc_id"]
    entries = own.where("start <= end").select("doc_id", F.col("start").cast("long").alias("_at"), F.lit(0).alias("_kind"), F.struct(*names).alias("_range"), "_run", *[F.lit(None).cast(pages.schema[c].dataType).alias(c) for c in columns])
    looked = pages.select("doc_id", F.col("page").cast("long").alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast(entries.schema["_range"].dataType).alias("_range"), F.lit(None).cast("long").alias("_run"), *columns)
    rows = entries.unionByName(looked).withColumn("_runs", F.max("_run").over(document))
    rows = rows.withColumn("_run", F.explode(F.when(F.col("_kind") == 0, F.array("_run")).otherwise(F.sequence(F.lit(0).cast("long"), "_runs"))))
    before = Window.partitionBy("doc_id", "_run").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.withColumn("_range", F.last("_range", ignorenulls=True).over(before)).where((F.col("_kind") == 1) & (F.col("_at") <= F.col("_range.end")))
    return found.select("doc_id", *columns, *[F.col(f"_range.{c}").alias(c) for c in names])


def _emit(groups: DataFrame, level: str, limits: Limits, order: list[str]) -> DataFrame:
    """Groups within the size as they are, longer ones as overlapping segments."""
    fits = F.length("text") <= limits.most
    whole = groups.where(fits).withColumns({"seq": F.lit(0), "chunk_level": F.lit(level)})
    parts = split_long(groups.where(~fits), "text", limits, "seq", "_total").withColumn("chunk_level", F.lit("split"))
    return whole.unionByName(parts.select(whole.columns)).select("doc_id", F.array(*(F.col(c).cast("long") for c in [*order, "seq"])).alias("at"), "chunk_level", F.col("title").alias("section_title"), "page_start", "page_end", "content_types", "text")


def by_sections(pages: DataFrame, contents: DataFrame, page_counts: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """A chunk for each section; sections that are too long go by runs of pages."""
    ranges = section_ranges(contents, page_counts)
    own = in_sections(usable(pages), ranges)
    key = ["doc_id", "position", "title", "start", "end"]
    whole = _grouped(own, key).withColumn("text", with_section(F.col("text"), F.col("title"))).where(F.length("text") >= limits.section_least)
    short = whole.where(F.length("text") <= limits.most).withColumns({"page_start": F.col("start"), "page_end": F.col("end"), "run": F.lit(0)})
    long = whole.where(F.length("text") > limits.most).select("doc_id", "position")
    w = Window.partitionBy("doc_id", "position").orderBy("page")
    runs = own.join(long, ["doc_id", "position"], "left_semi").withColumn("run", F.floor((F.row_number().over(w) - 1) / limits.pages).cast("int"))
    split = _grouped(runs, ["doc_id", "position", "title", "run"]).withColumn("text", with_section(F.col("text"), F.col("title")))
    columns = ["doc_id", "position", "run", "title", "text", "content_types", "page_start", "page_end"]
    return _emit(short.select(columns).unionByName(split.select(columns)), "section", limits, ["position", "run"])


def page_groups(pages: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Usable pages with the heading they are under (carried on from the last page that
    has one), the number of its run and of the block within it."""
    doc = Window.partitionBy("doc_id").orderBy("page")
    carried = F.coalesce(F.last("heading", ignorenulls=True).over(doc.rowsBetween(Window.unboundedPreceding, 0)), F.lit(""))
    rows = usable(pages).withColumn("title", carried)
    rows = rows.withColumn("new", F.coalesce((F.col("title") != F.lag("title").over(doc)).cast("int"), F.lit(0)))
    rows = rows.withColumn("run", F.sum("new").over(doc))
    return rows.withColumn("block", F.floor((F.row_number().over(Window.partitionBy("doc_id", "run").orderBy("page")) - 1) / limits.pages).cast("int")).drop("new")


def by_pages(pages: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """A chunk for each block of pages under one heading."""
    groups = _grouped(page_groups(pages, limits), ["doc_id", "run", "block", "title"])
    groups = groups.withColumn("text", with_section(F.col("text"), F.col("title"))).where(F.length("text") >= limits.least)
    return _emit(groups, "page", limits, ["run", "block"])


def number_chunks(parts: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Final chunks: trimmed, short ones dropped, numbered in order and counted for each document."""
    rows = parts.withColumn("text", strip(F.col("text"))).where(F.length("text") >= limits.least)
    doc = Window.partitionBy("doc_id")
    rows = rows.withColumns({"chunk_index": F.row_number().over(doc.orderBy("at")) - 1, "chunk_total": F.count(F.lit(1)).over(doc)})
    types = F.when(F.size("content_types") > 0, F.col("content_types")).otherwise(F.array(F.lit("text")))
    return rows.select(chunk_id(F.col("doc_id").cast("string"), F.col("chunk_index")).alias("chunk_id"), "doc_id", "chunk_index", F.col("chunk_total").cast("int").alias("chunk_total"), "chunk_level", "section_title", "page_start", "page_end", types.alias("content_types"), F.col("text").alias("chunk_text"))


def chunk_documents(pages: DataFrame, contents: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """All documents: by their contents where these have enough entries, else by headings."""
    entries = contents.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= limits.contents_least).select("doc_id")
    counts = pages.groupBy("doc_id").agg(F.max("page").alias("page_count"))
    sections = by_sections(pages.join(entries, "doc_id", "left_semi"), contents.join(entries, "doc_id", "left_semi"), counts, limits)
    return number_chunks(sections.unionByName(by_pages(pages.join(entries, "doc_id", "left_anti"), limits)), limits)


def level_summary(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("chunk_level").agg(F.count(F.lit(1)).alias("n")).orderBy("chunk_level")
