"""Exact filtered similarity search, and the prompt made of its results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import cosine_similarity, has_direction

FEWEST, DEFAULT, MOST = 3, 8, 20


def matches(vector: str, file_name: Column | None = None, level: Column | None = None, content_type: Column | None = None, section: Column | None = None) -> Column:
    """The predicate of a search; each further condition is a boolean column, or None."""
    out = F.col(vector).isNotNull() & has_direction(vector)
    for more in (file_name, level, content_type, section):
        if more is not None:
            out = out & more
    return out


def top_k(chunks: DataFrame, query: DataFrame, vector: str, key: str, k: int = DEFAULT, where: Column | None = None, decimals: int | None = None) -> DataFrame:
    """The k chunks most similar to the one row (column q) of ``query``, ties by key.

    One scan: the query row is broadcast, every task keeps its own k best and
    the driver-side merge is of k rows a task (TakeOrderedAndProject).
    """
    rows = chunks.where(matches(vector) if where is None else where)
    similarity = cosine_similarity(vector, "q")
    similarity = F.round(similarity, decimals) if decimals else similarity
    scored = rows.crossJoin(F.broadcast(query.select("q").limit(1))).withColumn("similarity", similarity).drop("q")
    return scored.orderBy(F.desc_nulls_last("similarity"), key).limit(min(max(k, FEWEST), MOST))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values, without nulls and blanks."""
    return df.where(F.col(column).isNotNull() & (F.col(column).cast("string") != "")).select(column).distinct().orderBy(column)


def with_defaults(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "section_title": F.coalesce("section_title", F.lit("—")),
        "content_types": F.coalesce("content_types", F.array().cast("array<string>")),
        "text": F.coalesce("text", F.lit("")),
        "file_path": F.coalesce("file_path", F.lit("")),
        "similarity": F.coalesce("similarity", F.lit(0.0)),
    })


def context(results: DataFrame, rank: str) -> DataFrame:
    """One row: numbered context blocks of the (at most MOST) results, or NO_CONTEXT."""
    block = F.format_string("[CHUNK %d] doc=%s pages=%s-%s section=%s chunk_id=%s\n%s\n", F.col(rank), "file_name", F.col("page_start").cast("string"), F.col("page_end").cast("string"), "section_title", "chunk_id", "text")
    listed = results.agg(F.sort_array(F.collect_list(F.struct(F.col(rank).alias("r"), block.alias("b")))).alias("l"))
    joined = F.array_join(F.transform("l", lambda x: x["b"]), "\n---\n")
    return listed.select(F.when(F.size("l") > 0, joined).otherwise("NO_CONTEXT").alias("context"))


#: What the model is told; the subject is a parameter.
SYSTEM = "You answer questions about {subject} from the given context chunks alone. If they do not hold the answer, say that you cannot find it there. Cite as: (doc, pages, section, chunk_id)."
USER = "QUESTION:\n{question}\n\nCONTEXT CHUNKS:\n%s\n\nTASK:\n1) Answer from the context alone.\n2) List 3-8 citations that tie the main claims to chunks.\n"


def messages(results: DataFrame, rank: str, question: str, subject: str = "the documents") -> DataFrame:
    """One row: the messages of a chat request."""
    user = F.concat(F.lit(USER.split("%s")[0].format(question=question)), F.col("context"), F.lit(USER.split("%s")[1]))
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return context(results, rank).select(F.array(message("system", F.lit(SYSTEM.format(subject=subject))), message("user", user)).alias("messages"))


def citations(results: DataFrame, rank: str) -> DataFrame:
    """A line for each result."""
    return results.select(F.format_string("[%d] %s p.%s-%s | %s | %s | %.4f", F.col(rank), "file_name", F.col("page_start").cast("string"), F.col("page_end").cast("string"), "section_title", "chunk_id", "similarity").alias("citation"))


def as_json(results: DataFrame, columns: list[str]) -> DataFrame:
    """One row: the results' columns as a JSON array in the order of rank."""
    listed = results.agg(F.sort_array(F.collect_list(F.struct("rank", *columns))).alias("l"))
    return listed.select(F.to_json("l").alias("json"))
