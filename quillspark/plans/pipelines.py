"""Whole workloads made of the operators: ingest, rechunk, backfill and answers.

What calls a parser or a model is stored before it is used, so that each input
is parsed and sent once, also when a later step runs again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import batching, chunking, layout, ledger, metadata, regions, retrieval, tables, token_chunking
from ..operators.batching import Calls
from ..sources import extracted, pdf
from ..sources.store import stored

#: Characters of a table that are told to a model, and its share of sure words below which a text on an image or a chart is dropped.
TABLE_CHARS, SURE, SURE_CHART, FEW_WORDS = 2000, 0.60, 0.40, 5
#: Characters of a page's text that are told with a table and with a chart, and what stands before a chart's labels.
TABLE_CONTEXT, CHART_CONTEXT, LABELS = 400, 600, "[CHART LABELS/VALUES]"


@dataclass(frozen=True)
class Providers:
    """Calls that executors can load; what is missing is left out."""

    embed: Callable[[list[str]], list]
    ocr: Callable[[list[bytes]], list[tuple[str, float]]] | None = None
    summarise: Callable[[list[str]], list[str]] | None = None
    #: Descriptions of charts, of (image, context, labels): the page's text, and what is recognised on the image.
    describe: Callable[[list[dict]], list[str]] | None = None


#: Requests to recognisers and summarisers: of few items, in so many tasks at most.
SMALL_CALLS = Calls(batch_size=16, workers=8)


def _called(rows: DataFrame, value: str, provider: Callable[[list], list], schema: str, name: str, calls: Calls = SMALL_CALLS) -> DataFrame:
    """Rows with a provider's answers to a column, stored. ``schema`` names the answers' columns.

    At most ``calls.workers`` requests are under way. One that fails is tried
    again, one with a bad item is halved until that stands alone; an item without an answer has nulls.
    """
    keep = [c for c in rows.columns if c != value]
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    arrow = {"string": pa.string(), "double": pa.float64()}
    types = [arrow[part.split()[1]] for part in schema.split(", ")]

    def run(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, calls.batch_size):
                b = whole.slice(start, calls.batch_size)
                items = [(i, v, 1) for i, v in enumerate(b.column(b.schema.get_field_index(value)).to_pylist())]
                said = {i: a for i, status, _, a in batching.call_isolating(provider, items, calls.attempts) if status == "SUCCESS"}
                answers = [said.get(i) for i in range(len(items))]
                columns = zip(*(a if isinstance(a, tuple) else (a,) * (a is not None) or (None,) * len(names) for a in answers), strict=True)
                arrays = [*(b.column(b.schema.get_field_index(c)) for c in keep), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *names])

    return stored(rows.select(*keep, value).repartition(calls.workers).mapInArrow(run, f"{kinds}, {schema}"), name)


def analyse(elements: DataFrame) -> DataFrame:
    """Elements with their page's kind (native, scanned or blank), in reading order; images too small to say anything are left out."""
    elements = elements.where(~layout.is_small_image(F.col("kind")))
    page = Window.partitionBy("doc_id", "page")
    chars = F.coalesce(F.sum(F.when(F.col("kind") == "text", F.length(F.trim("text")))).over(page), F.lit(0))
    rows = elements.withColumn("page_kind", layout.page_kind(chars, F.count_if(F.col("kind") == "image").over(page)))
    by_page = rows.groupBy("doc_id", "page").agg(F.sort_array(F.collect_list(F.struct("ordinal", *layout.BOX))).alias("b"), F.max("x1").alias("width"))
    boxes = F.transform("b", lambda e: F.struct(*(F.coalesce(e[k], F.lit(0.0)).alias(k) for k in layout.BOX)))
    ordered = by_page.select("doc_id", "page", "b", F.posexplode(layout.reading_order(boxes, F.coalesce("width", F.lit(0.0)))).alias("place", "i"))
    places = ordered.select("doc_id", "page", F.get("b", F.col("i"))["ordinal"].alias("ordinal"), "place")
    return rows.join(places, ["doc_id", "page", "ordinal"]).withColumn("ordinal", F.col("place")).drop("place")


def _around(elements: DataFrame, most: int) -> DataFrame:
    """doc_id, page and context: the first characters of a page's text."""
    listed = F.sort_array(F.collect_list(F.struct("ordinal", "text")))
    texts = elements.where("kind = 'text' and trim(coalesce(text, '')) <> ''").groupBy("doc_id", "page").agg(listed.alias("l"))
    return texts.select("doc_id", "page", F.left(F.array_join(F.transform("l", lambda x: x["text"]), " "), F.lit(most)).alias("context"))


def recognise(elements: DataFrame, ocr: Callable[[list[bytes]], list[tuple[str, float]]], describe: Callable[[list[dict]], list[str]] | None = None) -> DataFrame:
    """Elements whose images have the text that is recognised on them, if it is sure enough.
    On a scanned page that is the page's text; axes' numbers around an image make it a chart, which may be described as well."""
    key = ["doc_id", "page"]
    named = elements.withColumn("id", F.col("ordinal"))
    images = layout.charts(named.where("kind = 'image'").select(*key, "id", *layout.BOX, "image"), named.where("kind = 'text'").select(*key, "id", *layout.BOX, "text"), key)
    read = _called(images.where("image is not null").select(*key, "id", "is_chart", "image"), "image", ocr, "said string, confidence double", "recognised")
    words = F.size(F.filter(F.split("said", r"\s+"), lambda w: w != ""))
    sure = (F.col("confidence") >= F.when(F.col("is_chart"), SURE_CHART).otherwise(SURE)) | (words <= FEW_WORDS)
    said = read.select(*key, F.col("id").alias("ordinal"), F.when(sure, F.col("said")).alias("said"), "is_chart")
    if describe:
        said = stored(said, "said")
        told = F.struct("image", F.coalesce("context", F.lit("")).alias("context"), F.coalesce("said", F.lit("")).alias("labels")).alias("told")
        charts = said.where("is_chart").join(images.select(*key, F.col("id").alias("ordinal"), "image"), [*key, "ordinal"]).join(_around(elements, CHART_CONTEXT), key, "left")
        found = _called(charts.select(*key, "ordinal", told), "told", describe, "description string", "descriptions")
        labels = F.when(F.coalesce("said", F.lit("")) != "", F.concat(F.lit(f"\n\n{LABELS}\n"), F.col("said"))).otherwise("")
        said = said.join(found, [*key, "ordinal"], "left").withColumn("said", F.when(F.coalesce("description", F.lit("")) != "", F.concat("description", labels)).otherwise(F.col("said"))).drop("description")
    joined = elements.join(said, [*key, "ordinal"], "left")
    kind = F.when((F.col("kind") == "image") & (F.col("page_kind") == "scanned"), "text").when(F.coalesce("is_chart", F.lit(False)), "chart").otherwise(F.col("kind"))
    return joined.withColumns({"text": F.when(F.col("kind") == "image", F.coalesce("said", F.lit(""))).otherwise(F.col("text")), "kind": kind}).drop("said", "is_chart")


def with_tables(elements: DataFrame, summarise: Callable[[list[str]], list[str]] | None) -> DataFrame:
    """Elements whose tables have their text: Markdown with a summary, or plain."""
    w = Window.partitionBy("doc_id", "page").orderBy("ordinal")
    cells = elements.where("kind = 'table'").withColumn("table_index", F.row_number().over(w) - 1).where("cells is not null")
    found = tables.process_tables(cells.select("doc_id", "page", "table_index", "cells")).select("doc_id", "page", "table_index", "markdown", "plain_text")
    if summarise:
        found = stored(found, "tables")
        context = F.when(F.coalesce("context", F.lit("")) != "", F.concat(F.lit("\n\nText of the page:\n"), F.col("context"))).otherwise("")
        long = found.where(F.length("markdown") >= tables.SUMMARY_CHARS).join(_around(elements, TABLE_CONTEXT), ["doc_id", "page"], "left")
        asked = long.select("doc_id", "page", "table_index", F.concat(F.left("markdown", F.lit(TABLE_CHARS)), context).alias("shown"))
        found = found.join(_called(asked, "shown", summarise, "summary string", "summaries"), ["doc_id", "page", "table_index"], "left")
    else:
        found = found.withColumn("summary", F.lit(None).cast("string"))
    texts = found.select("doc_id", "page", "table_index", tables.best_text(F.col("markdown"), F.col("summary"), F.col("plain_text")).alias("best_text"))
    return tables.into_elements(elements, texts)


@dataclass(frozen=True)
class Ingested:
    chunks: DataFrame
    log: DataFrame


def ingest(files: DataFrame, contents: DataFrame, log: DataFrame, parser: Callable, providers: Providers, dimensions: int, now: Column, limits: chunking.Limits = chunking.Limits(), calls: Calls = Calls(), force: bool = False, find_tables: bool = False) -> Ingested:
    """Chunks with vectors of the files that the log does not hold as done (or of all, by force), and the log after them.

    ``files`` is metadata; ``contents`` (doc_id and content, or for a parser of
    pages doc_id and path) is read only for what
    survives the decision. A file that cannot be parsed, has no chunk or gets
    no vector is logged as an error, and the others go on; a page that cannot be read is left out of its file.
    With ``find_tables`` text boxes that stand in rows and columns become tables, for parsers that give no cells.
    """
    wanted = stored(ledger.decide(files, log, force=force).where("should_process").select("doc_id", "file_name", "file_path", "file_hash", "file_size", "last_modified"), "wanted")
    taken = contents.join(wanted.select("doc_id"), "doc_id", "left_semi")
    parsed = stored(pdf.parse(taken, parser) if "content" in contents.columns else pdf.parse_ranges(taken, parser), "elements")
    toc = parsed.where("kind = 'toc'").select("doc_id", F.col("ordinal").alias("position"), F.col("text").alias("title"), "page")
    placed = parsed.where("error is null and kind <> 'toc'")
    elements = analyse(stored(regions.into_elements(placed), "placed") if find_tables else placed)
    if providers.ocr:
        elements = recognise(stored(elements, "analysed"), providers.ocr, providers.describe)
    pages = chunking.pages_of(with_tables(stored(elements, "read"), providers.summarise))
    chunks = stored(_embedded(chunking.chunk_documents(pages, toc, limits), providers.embed, dimensions, calls).join(wanted.select("doc_id", "file_name", "file_path"), "doc_id"), "embedded")
    counts = chunks.groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("chunk_count"), F.count_if(F.col("embedding_status") == "SUCCESS").alias("good"))
    seen = parsed.groupBy("doc_id").agg(F.max("page").alias("pages_total"), F.max(F.when(F.col("page").isNull(), F.col("error"))).alias("failure"))
    rows = wanted.join(seen, "doc_id", "left").join(counts, "doc_id", "left")
    error = F.when(F.col("failure").isNotNull(), F.left("failure", F.lit(2000))).when(F.col("chunk_count").isNull(), "no chunks").when(F.col("good") == 0, "no vectors")
    changes = rows.select(*wanted.columns, F.when(error.isNull(), "SUCCESS").otherwise("ERROR").alias("status"), error.alias("error_message"), F.coalesce("chunk_count", F.lit(0)).alias("chunk_count"), F.coalesce("pages_total", F.lit(0)).alias("pages_total"), error.isNotNull().alias("increment_retry"))
    return Ingested(chunks, ledger.upsert_log(log, changes, now))


def rechunk(rows: DataFrame, mapping: dict[str, str], policy: token_chunking.Policy, rules: dict | None = None, tokenizer=None) -> DataFrame:
    """Chunks by tokens, with metadata, of documents that are already text; those that cannot be cut are left out."""
    return rechunk_settling(rows, mapping, policy, rules, tokenizer)[0]


def rechunk_settling(rows: DataFrame, mapping: dict[str, str], policy: token_chunking.Policy, rules: dict | None = None, tokenizer=None) -> tuple[DataFrame, DataFrame]:
    """The same, and doc_id and error of the documents that cannot be cut."""
    docs = extracted.documents(rows, mapping)
    element = lambda p: F.array(F.struct(F.lit("text").alias("kind"), p["text"].alias("text")))
    structured = docs.select("doc_id", F.transform("pages", lambda p: F.struct(p["page"].cast("int").alias("page"), element(p).alias("elements"))).alias("pages"), F.array().cast("array<struct<level:int,title:string,page:int>>").alias("contents"))
    cut = stored(token_chunking.chunk_documents(structured, policy, tokenizer), "cut")
    chunks, failed = cut.where("error is null").drop("error"), cut.where("error is not null").select("doc_id", "error")
    rules = rules or {}
    pages = docs.select("doc_id", F.inline("pages"))
    return metadata.attach(chunks, pages, rules.get("document", {}), rules.get("chunk", {}), rules.get("inherit_document_fields", True)).join(docs.select("doc_id", "file_path", "file_name", "source_hash"), "doc_id"), failed


def _embedded(chunks: DataFrame, provider: Callable, dimensions: int, calls: Calls) -> DataFrame:
    chunks = stored(chunks, "chunks")
    found = stored(batching.embed(chunks, "chunk_id", "chunk_text", provider, dimensions, calls), "vectors")
    return chunks.join(found.select(F.col("key").alias("chunk_id"), F.col("status").alias("embedding_status"), F.col("vector").alias("chunk_vector")), "chunk_id")


def eligible(source: DataFrame, vector: str, reuse: bool = True, most: int | None = None) -> int:
    """How many rows a backfill would take: the count of a dry run."""
    n = source.where(F.col(vector).isNull() if reuse else F.lit(True)).count()
    return n if most is None else min(n, most)


def discover(source: DataFrame, key: str, vector: str, reuse: bool = True, after=None, page: int | None = None) -> DataFrame:
    """Ids to embed, in order, beyond a cursor and at most a page of them."""
    rows = source.where(F.col(vector).isNull() if reuse else F.lit(True)).select(key)
    if after is not None:
        rows = rows.where(F.col(key) > F.lit(after))
    rows = rows.orderBy(key)
    return rows if page is None else rows.limit(page)


def backfill(source: DataFrame, key: str, text: str, vector: str, provider: Callable, dimensions: int, reuse: bool = True, calls: Calls = Calls(), ids: DataFrame | None = None) -> DataFrame:
    """The outcome of every row of a source, or of the wanted ids: what is skipped, refused, embedded, or had changed meanwhile."""
    tokens = batching.total_tokens(F.col(text))
    classed = stored(ledger.classify(source.select(key) if ids is None else ids.select(key), source, key, text, vector, tokens, reuse=reuse, batch_tokens=calls.batch_tokens), "classes")
    todo = classed.where(F.col("class") == "BATCH")
    done = stored(batching.embed(todo, key, text, provider, dimensions, calls), "vectors")
    keyed = todo.select(F.col(key).cast("string").alias("key"), F.col(key).alias("_id"), F.md5(F.col(text)).alias("digest"))
    fresh = done.join(keyed, "key").select(F.col("_id").alias(key), "digest", F.col("vector").alias("new_vector"), "status", "message")
    good = ledger.commit_vectors(source, fresh.where("status = 'SUCCESS'"), key, text, vector, reuse)
    bad = fresh.where("status <> 'SUCCESS'").select(key, F.lit(None).cast("array<float>").alias("new_vector"), F.concat(F.lit("FAILED/"), F.coalesce("message", F.lit("API_FAILURE"))).alias("outcome"))
    rest = classed.where(F.col("class") != "BATCH").select(key, F.lit(None).cast("array<float>").alias("new_vector"), F.col("class").alias("outcome"))
    return good.unionByName(bad).unionByName(rest)


@dataclass(frozen=True)
class Round:
    """What a round of a backfill leaves: all tasks, the outcomes of its own, and its failure events."""

    tasks: DataFrame
    outcomes: DataFrame
    events: DataFrame


def backfill_round(source: DataFrame, tasks: DataFrame, job: str, owner: str, token: str, now: Column, key: str, text: str, vector: str, provider: Callable, dimensions: int, limit: int, lease_seconds: int = 300, reuse: bool = True, calls: Calls = Calls(), latest: Callable[[], DataFrame] | None = None) -> Round:
    """Claim tasks, embed their rows and settle them.

    A result counts only for a task that still has the claim's token in the
    ``latest`` tasks, so a worker that lost its lease changes nothing.
    """
    claimed = stored(ledger.claim(tasks.where(F.col("job_key") == job), owner, token, now, lease_seconds, limit), "claimed")
    mine = claimed.where(F.col("claim_token") == token)
    ids = mine.select(F.col("row_id").cast(source.schema[key].dataType).alias(key))
    outcomes = stored(backfill(source, key, text, vector, provider, dimensions, reuse, calls, ids), "outcomes")
    status, code = F.split_part("outcome", F.lit("/"), F.lit(1)), F.nullif(F.split_part("outcome", F.lit("/"), F.lit(2)), F.lit(""))
    moved = F.col("outcome") == "SOURCE_CHANGED"
    results = outcomes.select(F.lit(job).alias("job_key"), F.col(key).cast(tasks.schema["row_id"].dataType).alias("row_id"), F.lit(token).alias("claim_token"), F.when(moved, "SKIPPED").otherwise(status).alias("status"), F.when(moved, F.col("outcome")).otherwise(F.split_part(code, F.lit(":"), F.lit(1))).alias("code"), F.when(~moved, code).alias("message"))
    after, events = ledger.finish(claimed if latest is None else latest(), results, now)
    return Round(after, outcomes, events)


def answer(chunks: DataFrame, query: DataFrame, question: str, chat: Callable[[list[dict]], str], k: int = retrieval.DEFAULT, **where) -> str:
    """Retrieve, build the prompt and ask: k rows and one message list reach the driver."""
    found = retrieval.top_k(chunks, query, "chunk_vector", "chunk_id", k, **where)
    ranked = retrieval.with_defaults(found).withColumn("rank", F.row_number().over(Window.orderBy(F.desc("similarity"), "chunk_id")))
    sent = retrieval.messages(ranked, "rank", question).first()["messages"]
    return chat([m.asDict() for m in sent])
