"""Row shapes of the engine's tables, and helpers for columns that may be missing."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INGESTION_LOG = "doc_id string, file_path string, file_name string, file_hash string, file_size long, last_modified timestamp, status string, error_message string, retry_count int, chunk_count int, pages_total int, ingested_at timestamp, updated_at timestamp"
CHUNKS = "chunk_id string, doc_id string, file_name string, file_path string, chunk_index int, chunk_total int, chunk_level string, section_title string, page_start int, page_end int, content_types array<string>, chunk_text string, chunk_vector array<float>, created_at timestamp, updated_at timestamp"
PROFILE_RESULTS = "doc_id string, profile_hash string, source_hash string, chunk_count int, updated_at timestamp"
TASKS = "job_key string, row_id string, status string, owner string, claim_token string, lease_until timestamp, attempts int, error_code string, error_message string, processing_comment string, updated_at timestamp"
QUOTA = "deployment_key string, rpm double, tpm double, requests double, tokens double, last_refill timestamp, cooldown timestamp, multiplier double"
LOCKS = "doc_id string, owner string, until timestamp"
RUNS = "job_key string, deployment_key string, rpm double, tpm double, profile_name string, source_table string, started_at timestamp"
ELEMENTS = "doc_id string, page int, ordinal int, kind string, x0 double, y0 double, x1 double, y1 double, text string"

#: Types that may identify a row of a mapped table.
ID_TYPES = (T.IntegerType, T.LongType, T.ShortType, T.StringType)


def col_or_null(df: DataFrame, name: str, kind: str) -> Column:
    """A column cast to a type, or a typed null where the table lacks it."""
    return (F.col(f"`{name}`") if name in df.columns else F.lit(None)).cast(kind)


def identifier(name: str) -> str:
    """A checked and quoted name for SQL text."""
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name or ""):
        raise ValueError(f"not an identifier: {name!r}")
    return f"`{name}`"


def validate_source(df: DataFrame, id_column: str, text_column: str, vector_column: str, dimensions: int) -> None:
    """Refuse a mapped table whose columns, types, vectors or ids do not fit.

    The checks of values are one aggregation over the id and vector columns.
    """
    missing = {id_column, text_column, vector_column} - set(df.columns)
    if missing:
        raise ValueError(f"missing columns: {', '.join(sorted(missing))}")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    if not isinstance(kinds[id_column], ID_TYPES):
        raise ValueError("the id column must be an integer or a string")
    if not isinstance(kinds[text_column], T.StringType):
        raise ValueError("the text column must be a string")
    if not isinstance(kinds[vector_column], T.ArrayType) or not isinstance(kinds[vector_column].elementType, (T.FloatType, T.DoubleType)):
        raise ValueError("the vector column must be an array of numbers")
    per_id = df.groupBy(id_column).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(vector_column).isNotNull() & (F.size(vector_column) != dimensions)).alias("bad"))
    found = per_id.agg(F.coalesce(F.max("n"), F.lit(0)).alias("most"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"), F.count_if(F.col(id_column).isNull()).alias("nulls")).first()
    if found["nulls"]:
        raise ValueError("the id column has nulls")
    if found["most"] > 1:
        raise ValueError("the id column is not unique")
    if found["bad"]:
        raise ValueError(f"vectors must have {dimensions} dimensions")
