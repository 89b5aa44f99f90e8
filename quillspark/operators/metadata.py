"""Metadata fields by rules: a label at the start of a line, a pattern, or a constant."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip

#: Characters from the start that rules look at, unless told otherwise (None: the whole text).
MOST_CHARS = 250_000


def extract(text: Column, rule: dict, most: int | None = MOST_CHARS) -> Column:
    """The trimmed value, or null where nothing is found."""
    method = rule["method"]
    if method == "constant":
        return F.lit(rule["value"]).cast("string")
    head = text if most is None else F.substring(text, 1, most)
    if method == "label":
        pattern = rf"(?im)^\s*\Q{rule['label']}\E\s*[:#\-]\s*(.+?)\s*$"
        group = 1
    else:
        pattern = "(?m)" + rule["pattern"]
        group = min(1, re.compile(rule["pattern"]).groups)
    return F.nullif(strip(F.regexp_extract(head, pattern, group)), F.lit(""))


def fields(text: Column, rules: dict[str, dict], most: int | None = MOST_CHARS) -> Column:
    """A map of the fields that have a value."""
    if not rules:
        return F.create_map().cast("map<string,string>")
    entries = F.array(*(F.struct(F.lit(n).alias("key"), extract(text, r, most).alias("value")) for n, r in sorted(rules.items())))
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def document_fields(pages: DataFrame, rules: dict[str, dict]) -> DataFrame:
    """doc_id and document_metadata: each rule over the first pages that it names (3 by default)."""
    scopes = sorted({r.get("first_pages", 3) for r in rules.values()})
    texts = {n: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("page") <= n, F.struct("page", "text")))), lambda p: p["text"]), "\n").alias(f"t{n}") for n in scopes}
    if not rules:
        return pages.select("doc_id").distinct().withColumn("document_metadata", fields(F.lit(""), {}))
    rows = pages.where(F.col("page") <= max(scopes)).groupBy("doc_id").agg(*texts.values())
    entries = F.array(*(F.struct(F.lit(n).alias("key"), extract(F.col(f"t{r.get('first_pages', 3)}"), r).alias("value")) for n, r in sorted(rules.items())))
    found = rows.select("doc_id", F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())).alias("document_metadata"))
    return pages.select("doc_id").distinct().join(found, "doc_id", "left").withColumn("document_metadata", F.coalesce("document_metadata", fields(F.lit(""), {})))


def attach(chunks: DataFrame, pages: DataFrame, document_rules: dict, chunk_rules: dict, inherit: bool = True) -> DataFrame:
    """Chunks with document_metadata, chunk_metadata and effective_metadata (a chunk's own value wins)."""
    rows = chunks.join(document_fields(pages, document_rules), "doc_id", "left").withColumn("chunk_metadata", fields(F.col("chunk_text"), chunk_rules))
    own = F.col("chunk_metadata")
    inherited = F.map_filter("document_metadata", lambda k, v: ~F.map_contains_key(own, k))
    return rows.withColumn("effective_metadata", F.map_concat(inherited, own) if inherit else own)
