"""Coverage of documents by embedded chunks.

Chunks are rows with a document, a vector flag, a note flag and a time. Each
query is one scan of those narrow columns: texts and vectors are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.status import coverage, document_stage

PRIORITIES, DETAILS = 25, 200


def per_document(chunks: DataFrame, doc_id: Column, embedded: Column, noted: Column, name: Column, updated: Column) -> DataFrame:
    """A row for each document; a blank or missing id is the null document."""
    key = F.nullif(F.trim(doc_id.cast("string")), F.lit(""))
    rows = chunks.select(key.alias("doc_id"), embedded.alias("e"), noted.alias("n"), name.alias("f"), updated.alias("u"))
    return rows.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("chunks"),
        F.count_if("e").alias("embedded"),
        F.count_if(~F.col("e") & F.col("n")).alias("noted"),
        F.min("f").alias("file_name"),
        F.max("u").alias("last_update"),
    )


def totals(documents: DataFrame) -> DataFrame:
    """One row over the documents; chunks without a document count as unmapped."""
    known = F.col("doc_id").isNotNull()
    count = lambda c: F.count_if(known & c).alias
    some, all_ = F.col("embedded") > 0, F.col("embedded") >= F.col("chunks")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return documents.agg(
        F.count_if(known).alias("total_documents"),
        count(all_)("completed"),
        count(some & ~all_)("partial"),
        count(~some)("untouched"),
        count(F.col("noted") > 0)("attention"),
        total("chunks").alias("total_chunks"),
        total("embedded").alias("embedded_chunks"),
        total(F.col("chunks") - F.col("embedded")).alias("missing_chunks"),
        total(F.when(~known, F.col("chunks"))).alias("unmapped_chunks"),
    )


def priorities(documents: DataFrame, limit: int = PRIORITIES) -> DataFrame:
    """The documents that miss most chunks: a bounded report."""
    gap = F.col("chunks") - F.col("embedded")
    rows = documents.where(F.col("doc_id").isNotNull() & (gap > 0)).withColumn("missing", gap)
    return rows.orderBy(F.desc("missing"), "doc_id").limit(limit)


def shown_priorities(priorities_: DataFrame) -> DataFrame:
    """Priorities as they are shown: with a dash for no name, and the share in per cent."""
    return priorities_.select("doc_id", F.coalesce("file_name", F.lit("—")).alias("file_name"), "chunks", "embedded", "missing", F.round(100 * coverage(F.col("embedded"), F.col("chunks")), 1).alias("coverage_pct"), F.coalesce("noted", F.lit(0)).alias("noted"))


def with_stage(documents: DataFrame) -> DataFrame:
    chunks, embedded = F.col("chunks"), F.col("embedded")
    return documents.withColumns({"stage": document_stage(chunks, embedded), "coverage_pct": F.round(100 * coverage(embedded, chunks), 1)})


def totals_with_priorities(documents: DataFrame, limit: int = PRIORITIES) -> DataFrame:
    """Totals, and the priorities as JSON, in one row."""
    top = priorities(documents, limit).select(F.struct("missing", "doc_id", "chunks", "embedded").alias("x"))
    nested = top.agg(F.sort_array(F.collect_list(F.struct((-F.col("x.missing")).alias("o"), F.col("x.doc_id").alias("d"), "x"))).alias("l"))
    nested = nested.select(F.to_json(F.transform("l", lambda e: e["x"])).alias("priorities"))
    return totals(documents).crossJoin(F.broadcast(nested))  # one row each


def details(chunks: DataFrame, doc_id: Column, wanted: str, index: Column, chunk_id: Column, columns: dict[str, Column], limit: int = DETAILS) -> DataFrame:
    """The first chunks of one document by index (missing ones last) and id, and whether there are more."""
    rows = chunks.where(F.trim(doc_id.cast("string")) == wanted).select(index.alias("chunk_index"), chunk_id.alias("chunk_id"), *(c.alias(n) for n, c in columns.items()))
    top = rows.orderBy(F.asc_nulls_last("chunk_index"), "chunk_id").limit(limit + 1)
    # the limit bounds both sides: at most limit + 1 rows
    size = top.agg((F.count(F.lit(1)) > limit).alias("truncated"))
    return top.crossJoin(F.broadcast(size)).orderBy(F.asc_nulls_last("chunk_index"), "chunk_id").limit(limit)


def single_summary(chunks: DataFrame, doc_id: Column, wanted: str, embedded: Column, noted: Column, total: Column) -> DataFrame:
    rows = chunks.where(F.trim(doc_id.cast("string")) == wanted).select(embedded.alias("e"), noted.alias("n"), total.alias("t"))
    return rows.agg(F.count(F.lit(1)).alias("chunks"), F.count_if("e").alias("embedded"), F.max("t").alias("declared_total"), F.count_if(~F.col("e") & F.col("n")).alias("noted"))


def vector_stats(rows: DataFrame, vector: str, tokens: Column) -> DataFrame:
    """How many vectors point anywhere; an empty one counts as zero too, on purpose."""
    v = F.col(vector)
    return rows.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.exists(v, lambda x: x != 0)).alias("with_vector"),
        F.count_if(F.forall(v, lambda x: x == 0)).alias("zero_vector"),
        F.count_if(F.coalesce(F.size(v), F.lit(0)) <= 0).alias("empty_vector"),
        F.round(F.avg(tokens), 1).alias("avg_tokens"),
        F.max(tokens).alias("max_tokens"),
    )
