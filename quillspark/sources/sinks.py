"""Tables on storage without MERGE: a new version is written beside the old and takes its place."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import csv_guard
from ..functions.vectors import is_valid
from .store import stored


def ensure(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at a path, made empty if there is none; columns that it lacks are added as nulls."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        spark.createDataFrame([], schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def replace(df: DataFrame, path: str, partition_by: list[str] = []) -> None:  # noqa: B006
    """Write a next version beside the table, then swap by renaming; the old one goes last."""
    spark = df.sparkSession
    fs, target = _fs(spark, path)
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    tag = uuid.uuid4().hex
    new, old = f"{path.rstrip('/')}.new-{tag}", Path(f"{path.rstrip('/')}.old-{tag}")
    df.write.partitionBy(*partition_by).parquet(new)
    had = fs.exists(target)
    if had:
        fs.rename(target, old)
    fs.rename(Path(new), target)
    if had:
        fs.delete(old, True)


def upsert(table: DataFrame, rows: DataFrame, key: list[str], update: list[str], now: Column | None = None) -> DataFrame:
    """The table after an upsert: a row whose key is there changes only the update columns (and updated_at)."""
    marked = rows.select(*key, *(F.col(c).alias(f"_n_{c}") for c in rows.columns if c not in key), F.lit(True).alias("_new"))
    joined = table.withColumn("_old", F.lit(True)).join(marked, key, "full")
    new, old = F.coalesce("_new", F.lit(False)), F.coalesce("_old", F.lit(False))

    def column(c: str) -> Column:
        if c in key:
            return F.col(c)
        given = f"_n_{c}" in joined.columns
        if c in ("created_at", "updated_at") and now is not None:
            fresh = now
        else:
            fresh = F.col(f"_n_{c}") if given else F.lit(None).cast(table.schema[c].dataType)
        takes = new & (~old | F.lit(c in update or c == "updated_at"))
        return F.when(takes, fresh).otherwise(F.col(c)).alias(c)

    return joined.select(*map(column, table.columns))


def replace_documents(table: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    """The table with all rows of the new rows' documents replaced: no stale chunk of a document that shrank stays."""
    return table.join(rows.select(*key).distinct(), key, "left_anti").unionByName(rows)


def delete_documents(table: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    return table.join(ids.select(key).distinct(), key, "left_anti")


def cascade(log: DataFrame, chunks: DataFrame) -> DataFrame:
    """Chunks whose document is still in the log."""
    return chunks.join(log.select("doc_id"), "doc_id", "left_semi")


def checked_profile_chunks(chunks: DataFrame, vector: str | None = None, dimensions: int = 0) -> DataFrame:
    """Chunks of one result, refused as a whole if a vector is not valid."""
    if vector is None:
        return chunks
    return chunks.withColumn(vector, F.when(is_valid(vector, dimensions), F.col(vector)).otherwise(F.raise_error(F.concat(F.lit("invalid vector in "), F.col("chunk_id")))))


def save_profile_result(results: DataFrame, chunks: DataFrame, new_chunks: DataFrame, profile_hash: str, now: Column) -> tuple[DataFrame, DataFrame]:
    """Results and chunks after all of the new chunks' documents are replaced for a profile."""
    fresh = new_chunks.withColumn("profile_hash", F.lit(profile_hash))
    summary = fresh.groupBy("doc_id", "profile_hash").agg(F.first("source_hash").alias("source_hash"), F.count(F.lit(1)).cast("int").alias("chunk_count")).withColumn("updated_at", now)
    key = ["doc_id", "profile_hash"]
    return replace_documents(results, summary.select(results.columns), key), replace_documents(chunks, fresh.select(chunks.columns), key)


def safe_csv(df: DataFrame) -> DataFrame:
    """All columns as guarded text, ready for write.csv."""
    return df.select(*(csv_guard(F.col(f"`{c}`").cast("string")).alias(c) for c in df.columns))


#: The column that a table is partitioned by, to be changed in parts.
BUCKET = "bucket"


def bucketed(df: DataFrame, key: list[str], buckets: int) -> DataFrame:
    """The rows with the bucket of their key, to be written partitioned by it."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))


def upsert_into(path: str, rows: DataFrame, key: list[str], update: list[str], buckets: int = 0, now: Column | None = None) -> None:
    """Upsert rows into the table at a path. Of a table of so many buckets only those that the rows
    fall into are read and written; one without is replaced as a whole. Running again changes nothing more."""
    table = rows.sparkSession.read.parquet(path)
    rows = rows.dropDuplicates(key).select(*[c for c in table.columns if c in rows.columns and c != BUCKET])
    if not buckets:
        replace(upsert(table, rows, key, update, now), path)
        return
    rows = bucketed(rows, key, buckets)
    touched = sorted(r[0] for r in rows.select(BUCKET).distinct().collect())  # at most all buckets
    if touched:
        after = stored(upsert(table.where(F.col(BUCKET).isin(touched)), rows, [*key, BUCKET], update, now), "upsert")
        after.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)


def foreach_upsert(path: str, key: list[str], update: list[str], buckets: int = 0) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: upserts each batch into the table at a path."""
    return lambda batch, batch_id: upsert_into(path, batch, key, update, buckets)
