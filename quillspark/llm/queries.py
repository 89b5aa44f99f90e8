"""One query for each training-data operator, with production parameters.

Each reads its whole tables, applies the operator and derives the columns of
its result from the operator's own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .oracle import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]
SHARDS, SEQUENCE = 24, 2048
#: Conversations open as the first of each 20 does, by 0 to 3 turns.
OPENING_PERIOD, OPENING_KINDS = 20, 4


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .kd_sharding import shard

    got = shard(_table(spark, sf_dir, "documents"), shards=SHARDS)
    return got.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .byte_bpe import round_trip

    return round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import held_out, identify, learn

    docs = _table(spark, sf_dir, "documents")
    got = identify(docs, learn(docs.where(~held_out(F.col("doc_id")))))
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .token_files import write_and_read

    return write_and_read(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import held_out, learn, score

    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    got = score(docs, learn(docs, labels.where(~held_out(F.col("doc_id")))))
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op6_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprints import edited_likeness

    return edited_likeness(_table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import remove_repeats

    got = remove_repeats(_table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "utf-8"), 256).alias("kept_sha256"))


def op8_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .cap_filters import near_vectors

    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack_documents

    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=0, capacity=SEQUENCE)


def op10_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bag_minhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import judge

    got = judge(_table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vector_codes import compress, digest, with_label_error

    codes, books = compress(_table(spark, sf_dir, "embeddings"))
    named = F.lit(None if books is None else digest(books)).cast("string")
    return with_label_error(codes).select("vec_id", "code", "error", "label_error", named.alias("codebooks_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prefix_trie import numbered, trie, with_openings
    from .shared import materialize

    turns = materialize(numbered(_table(spark, sf_dir, "conversations")), "turns")
    return trie(with_openings(turns, OPENING_PERIOD, OPENING_KINDS)).drop("digest")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_kd_sharding": op1_kd_sharding,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_language_id": op3_language_id,
    "op4_token_files": op4_token_files,
    "op5_toxicity": op5_toxicity,
    "op6_weighted_sampling": op6_weighted_sampling,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_cap_filters": op8_cap_filters,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_bag_minhash": op10_bag_minhash,
    "op11_quality_rules": op11_quality_rules,
    "op12_vector_codes": op12_vector_codes,
    "op13_prefix_trie": op13_prefix_trie,
}
