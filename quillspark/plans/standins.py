"""The engine's tables as views of the test tables, and the same views in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The moment that queries with a clock run at.
AS_OF = "2024-01-15 00:00:00"


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def chunk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as chunks: an order is a document, returnflag N has no vector, and of these linestatus O a note."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("doc_id"), F.col("l_linenumber").alias("chunk_index"), F.concat_ws("-", "l_partkey", "l_suppkey").alias("chunk_id"),
        (F.col("l_returnflag") != "N").alias("embedded"), ((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O")).alias("noted"),
        F.concat(F.lit("file-"), F.col("l_orderkey").cast("string")).alias("file_name"), F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("updated"),
    )


CHUNKS = """chunks AS (SELECT CAST(l_orderkey AS VARCHAR) doc_id, l_linenumber chunk_index, concat_ws('-', l_partkey, l_suppkey) chunk_id,
  l_returnflag <> 'N' embedded, (l_returnflag = 'N' AND l_linestatus = 'O') noted, 'file-' || CAST(l_orderkey AS VARCHAR) file_name, epoch_us(l_shipdate) updated FROM lineitem)"""


def task_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as tasks: twenty jobs, seven owners, a lease of an hour."""
    ts = F.col("ts").cast("timestamp")
    kinds = F.pmod(F.col("event_id"), F.lit(5))
    status = F.element_at(F.array(*(F.lit(s) for s in ("RUNNING", "SUCCESS", "FAILED", "PENDING", "SKIPPED"))), (kinds + 1).cast("int"))
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("job"), F.pmod("user_id", F.lit(20)).cast("string")).alias("job_key"), F.col("event_id").alias("row_id"), status.alias("status"),
        F.concat(F.lit("w"), F.pmod("user_id", F.lit(7)).cast("string")).alias("owner"), F.lit("t0").alias("claim_token"), (ts + F.expr("interval 1 hour")).alias("lease_until"), F.lit(1).alias("attempts"),
        F.when(kinds == 2, F.when(F.pmod(F.floor(F.col("event_id") / 5), F.lit(3)) == 0, None).otherwise(F.col("event_type"))).alias("error_code"), F.col("props").alias("error_message"), F.lit(None).cast("string").alias("processing_comment"), ts.alias("updated_at"),
    )


TASKS = """tasks AS (SELECT 'job' || CAST(user_id % 20 AS VARCHAR) job_key, event_id row_id, ['RUNNING','SUCCESS','FAILED','PENDING','SKIPPED'][CAST(event_id % 5 AS INTEGER) + 1] status,
  'w' || CAST(user_id % 7 AS VARCHAR) owner, ts + INTERVAL 1 HOUR lease_until, CASE WHEN event_id % 5 = 2 THEN CASE WHEN (event_id // 5) % 3 = 0 THEN NULL ELSE event_type END END error_code, props error_message, ts updated_at FROM events)"""


def log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as the ingestion log."""
    status = F.element_at(F.create_map(*(F.lit(x) for x in ("F", "SUCCESS", "O", "RUNNING", "P", "ERROR"))), F.col("o_orderstatus"))
    when = F.col("o_orderdate").cast("timestamp")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("doc_id"), F.concat(F.lit("/in/"), F.col("o_orderkey").cast("string"), F.lit(".pdf")).alias("file_path"), status.alias("status"), F.pmod("o_orderkey", F.lit(4)).cast("int").alias("retry_count"),
        F.md5(F.col("o_custkey").cast("string")).alias("file_hash"), F.pmod("o_custkey", F.lit(50)).cast("int").alias("chunk_count"), F.pmod("o_custkey", F.lit(9)).cast("int").alias("pages_total"), when.alias("last_modified"), when.alias("ingested_at"), when.alias("updated_at"),
    )


LOG = """log AS (SELECT CAST(o_orderkey AS VARCHAR) doc_id, '/in/' || CAST(o_orderkey AS VARCHAR) || '.pdf' file_path, CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'RUNNING' WHEN 'P' THEN 'ERROR' END status,
  CAST(o_orderkey % 4 AS INTEGER) retry_count, md5(CAST(o_custkey AS VARCHAR)) file_hash, CAST(o_custkey % 50 AS INTEGER) chunk_count, CAST(o_custkey % 9 AS INTEGER) pages_total, o_orderdate last_modified, o_orderdate ingested_at, o_orderdate updated_at FROM orders)"""


def file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a crawl finds now: some hashes and times have moved, some files are new, empty or unreadable."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    doc = F.when(F.pmod(key, F.lit(11)) == 0, F.concat(F.lit("new"), key.cast("string"))).otherwise(key.cast("string"))
    shift = F.when(F.pmod(key, F.lit(3)) == 0, F.lit(1)).when(F.pmod(key, F.lit(3)) == 1, F.lit(2)).otherwise(F.lit(5))
    return o.select(
        doc.alias("doc_id"), F.concat(F.lit("/in/"), key.cast("string"), F.when(F.pmod(key, F.lit(6)) == 0, ".xml").when(F.pmod(key, F.lit(6)) == 1, ".TXT").otherwise(".pdf")).alias("file_path"),
        F.md5(F.when(F.pmod(key, F.lit(5)) == 0, F.lit("x")).otherwise(F.col("o_custkey").cast("string"))).alias("file_hash"), F.when(F.pmod(key, F.lit(13)) == 0, 0).otherwise(key * 10).cast("long").alias("file_size"),
        F.timestamp_micros(F.unix_micros(F.col("o_orderdate").cast("timestamp")) + shift * 1_000_000).alias("last_modified"), (F.pmod(key, F.lit(17)) != 0).alias("readable"),
    )


FILES = """files AS (SELECT CASE WHEN o_orderkey % 11 = 0 THEN 'new' ELSE '' END || CAST(o_orderkey AS VARCHAR) doc_id,
  '/in/' || CAST(o_orderkey AS VARCHAR) || CASE o_orderkey % 6 WHEN 0 THEN '.xml' WHEN 1 THEN '.TXT' ELSE '.pdf' END file_path,
  md5(CASE WHEN o_orderkey % 5 = 0 THEN 'x' ELSE CAST(o_custkey AS VARCHAR) END) file_hash, CASE WHEN o_orderkey % 13 = 0 THEN 0 ELSE o_orderkey * 10 END file_size,
  epoch_us(o_orderdate) + CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 5 END * 1000000 modified_us, o_orderkey % 17 <> 0 readable FROM orders)"""


def with_(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"
