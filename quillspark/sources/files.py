"""Inventories of files: from folders, and from listings of object stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import path_id, path_slashes


def _glob(extensions: list[str]) -> str:
    """A path pattern for extensions in any case."""
    either = lambda e: "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in e.lstrip("."))
    return "*.{" + ",".join(map(either, extensions)) + "}" if len(extensions) > 1 else "*." + either(extensions[0])


def crawl(spark: SparkSession, root: str, extensions: list[str] = [".pdf"], with_hash: bool = False, most: int | None = None) -> DataFrame:  # noqa: B006
    """Files below a folder: doc_id, file_path, file_name, file_size, last_modified, and on demand file_hash;
    ``most`` takes only the first ones by path, for trial runs.

    Without the hash only metadata is read: the content column is pruned away.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", _glob(extensions))
    path = path_slashes(F.col("path"))
    rows = reader.load(root).select(
        path_id(path).alias("doc_id"), path.alias("file_path"), F.element_at(F.split(path, "/"), -1).alias("file_name"),
        F.col("length").alias("file_size"), F.col("modificationTime").alias("last_modified"), *([F.sha2("content", 256).alias("file_hash")] if with_hash else []),
    )
    return rows if most is None else rows.orderBy("file_path").limit(most)


def contents(spark: SparkSession, root: str, wanted: DataFrame, extensions: list[str] = [".pdf"]) -> DataFrame:  # noqa: B006
    """doc_id, content and file_hash of the wanted files (doc_id) below a folder, read on the executors."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", _glob(extensions))
    rows = reader.load(root).select(path_id(path_slashes(F.col("path"))).alias("doc_id"), "content", F.sha2("content", 256).alias("file_hash"))
    return rows.join(wanted.select("doc_id"), "doc_id", "left_semi")


def from_listing(listing: DataFrame, extensions: list[str] = [".pdf"]) -> DataFrame:  # noqa: B006
    """Files from rows of a store's listing (key, etag, size, last_modified, bucket): the ETag is the hash."""
    wanted = F.lit(False)
    for e in extensions:
        wanted = wanted | F.lower("key").endswith(e.lower())
    path = F.concat(F.lit("s3://"), F.col("bucket"), F.lit("/"), F.col("key"))
    return listing.where(wanted).select(path_id(path).alias("doc_id"), path.alias("file_path"), F.element_at(F.split("key", "/"), -1).alias("file_name"), F.col("size").alias("file_size"), "last_modified", F.replace("etag", F.lit('"'), F.lit("")).alias("file_hash"))


def store_uri(uri: str) -> tuple[str, str] | None:
    """Bucket and key of an s3:// address, or None if it is malformed."""
    if not uri.startswith("s3://"):
        return None
    bucket, _, key = uri[5:].partition("/")
    return (bucket, key) if bucket and key else None


def folder_summary(files: DataFrame) -> DataFrame:
    """Counts and bytes by kind of file and the last change, for each folder's own files."""
    folder = F.regexp_replace("file_path", r"/[^/]*$", "")
    kind = F.lower(F.regexp_extract("file_path", r"\.([^./]+)$", 1))
    size = F.col("file_size")
    columns = []
    for name, is_kind in (("pdf", kind == "pdf"), ("xml", kind == "xml"), ("other", ~kind.isin("pdf", "xml"))):
        columns += [F.count_if(is_kind).alias(f"{name}_files"), F.coalesce(F.sum(F.when(is_kind, size)), F.lit(0)).alias(f"{name}_bytes")]
    return files.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("files"), F.sum(size).alias("bytes"), *columns, F.max("last_modified").alias("last_modified"))


def unscanned(folders: DataFrame, summaries: DataFrame) -> DataFrame:
    return folders.join(summaries.select("folder"), "folder", "left_anti")


def work_queue(decided: DataFrame) -> DataFrame:
    """What is to be processed, small files first."""
    return decided.where("should_process").orderBy("file_size", "doc_id")
