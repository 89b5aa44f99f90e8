"""Documents whose text another system has extracted: rows of a mapped table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import col_or_null


def document_ids(rows: DataFrame, id_column: str, limit: int | None = None) -> DataFrame:
    """Distinct ids in order; a limit is a feature of trial runs."""
    ids = rows.where(F.col(id_column).isNotNull()).select(F.col(id_column).alias("doc_id")).distinct().orderBy("doc_id")
    return ids.limit(limit) if limit else ids


def documents(rows: DataFrame, mapping: dict[str, str], source: str = "table") -> DataFrame:
    """A row for each document: pages in order, path, name and a fingerprint of the content.

    ``mapping`` names the columns for doc_id and text, and may name position,
    page, file_path and file_name. Pages without a number are numbered in order.
    """
    col = lambda k, t: col_or_null(rows, mapping[k], t) if mapping.get(k) else F.lit(None).cast(t)
    slim = rows.select(
        F.col(mapping["doc_id"]).cast("string").alias("doc_id"), F.coalesce(col("position", "long"), col("page", "long")).alias("at"), col("page", "long").alias("page"),
        F.coalesce(F.col(mapping["text"]).cast("string"), F.lit("")).alias("text"), F.nullif(col("file_path", "string"), F.lit("")).alias("p"), F.nullif(col("file_name", "string"), F.lit("")).alias("n"),
    ).where("doc_id is not null")
    grouped = slim.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("at", "page", "text", "p", "n"))).alias("l"))
    pages = F.transform("l", lambda x, i: F.struct(F.coalesce(x["page"], (i + 1).cast("long")).alias("page"), x["text"].alias("text")))
    first = lambda c: F.get(F.filter(F.transform("l", lambda x: x[c]), lambda x: x.isNotNull()), F.lit(0))
    path = F.coalesce(first("p"), F.concat(F.lit(f"db://{source}/"), F.col("doc_id")))
    out = grouped.select("doc_id", pages.alias("pages"), path.alias("file_path"), F.coalesce(first("n"), F.element_at(F.split(path, "/"), -1)).alias("file_name"))
    checked = out.withColumn("pages", F.when(F.array_min(F.transform("pages", lambda x: x["page"])) < 1, F.raise_error(F.lit("page numbers start at 1"))).otherwise(F.col("pages")))
    return checked.withColumn("source_hash", fingerprint(F.col("pages")))


def fingerprint(pages) -> object:
    """SHA-256 of all pages' numbers and texts, in order."""
    zero = F.lit("\0")
    return F.sha2(F.array_join(F.transform(pages, lambda x: F.concat(x["page"].cast("string"), zero, x["text"], zero)), ""), 256)
