"""A corpus from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a table that is written as
Parquet and read again as the next one's input. All but the last return the
columns of documents:

* toxicity: drops documents that the model, fitted on the labels of the
  tables' folder, calls toxic,
* language: drops documents without a language (no letters); those in several
  languages stay; the model is fitted on the ``lang`` column of what is left,
* near_dedup: keeps the first document of each class of near copies; rows
  without an id stay, and of rows that repeat an id and its text one does,
* substring_dedup: removes repeated passages of 20 words or more; text becomes
  the words that stay, joined by one space, and n_chars its length; a text
  that nothing is left of stays as an empty one,
* packing: packs what is left into sequences of at most 2048 tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import bag_minhash, language_id, packing, substring_dedup, toxicity
from quillspark.llm.shared import materialize

CAPACITY, END_ID = 2048, 0


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.learn(docs, labels)
    return toxicity.filter_rows(docs, model)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.filter_rows(docs, language_id.learn(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    named, nameless = docs.where("doc_id is not null"), docs.where("doc_id is null")
    if named.groupBy("doc_id").count().where("count > 1").isEmpty():
        kept = bag_minhash.near_duplicates(named).where("kept").select("doc_id")
        out = named.join(kept, "doc_id", "left_semi")
    else:  # each row is decided by a number of its own, in the order of ids
        single = named.dropDuplicates(["doc_id", "text"]).sort("doc_id", "text")
        rows = materialize(single.withColumn("_row", F.monotonically_increasing_id()), "rows")
        kept = bag_minhash.near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text")).where("kept").select(F.col("doc_id").alias("_row"))
        out = rows.join(kept, "_row", "left_semi")
    return out.select(docs.columns).unionAll(nameless)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.filter_rows(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID, CAPACITY)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeats),
    ("packing", pack),
]

#: Learned models and packing have no SQL form; tests/llm holds each stage against a plain version of its own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
