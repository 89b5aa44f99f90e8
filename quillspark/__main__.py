"""Command line: python -m quillspark COMMAND ... (see --help)."""

from __future__ import annotations

import argparse
import importlib
import json
import sys
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config, logs, schema
from .operators import clients, jobs, ledger, providers, token_chunking
from .operators.batching import Calls
from .plans import catalog, pipelines, profile
from .session import session
from .sources import files, sinks


def plug_in(name: str):
    """An object by module:attribute, called if it is a class."""
    module, _, attribute = name.partition(":")
    found = getattr(importlib.import_module(module), attribute)
    return found() if isinstance(found, type) else found


def build() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="quillspark", description="Documents to searchable, monitored chunks.", allow_abbrev=False)
    top.add_argument("--config", help="INI file of settings")
    top.add_argument("--master", help="Spark master, if spark-submit does not give it")
    top.add_argument("--log-file")
    top.add_argument("--log-json", help="warnings as JSON lines")
    commands = top.add_subparsers(dest="command", required=True)
    c = commands.add_parser("query", help="run a query of the catalog")
    c.add_argument("name", choices=sorted(catalog.QUERIES))
    c.add_argument("--data", required=True, help="folder of Parquet tables")
    c.add_argument("--out", help="write Parquet there instead of showing rows")
    c = commands.add_parser("ingest", help="parse, chunk and embed the files below a folder, or one file")
    where = c.add_mutually_exclusive_group(required=True)
    where.add_argument("--root")
    where.add_argument("--file")
    c.add_argument("--log", required=True, help="table of the ingestion log")
    c.add_argument("--chunks", required=True, help="table of chunks")
    c.add_argument("--parser", default="quillspark.operators.providers:PlainTextParser", help="module:attribute")
    c.add_argument("--embedder", default="quillspark.operators.providers:HashEmbedder", help="module:attribute")
    c.add_argument("--dimensions", type=int, default=64)
    c.add_argument("--extension", action="append", help="of files to take; .pdf unless given")
    c.add_argument("--max-files", type=int)
    c.add_argument("--force", action="store_true", help="also files that are done")
    c.add_argument("--dry-run", action="store_true", help="count what would be done")
    c = commands.add_parser("rechunk", help="chunk extracted text by a profile")
    c.add_argument("--table", required=True)
    c.add_argument("--profile", required=True)
    c.add_argument("--set", action="append", default=[], metavar="SECTION.KEY=VALUE")
    c.add_argument("--out", required=True)
    c.add_argument("--ranks", help="file of ranks of the profile's tokenizer; without it words are counted")
    c = commands.add_parser("backfill", help="embed rows without a vector")
    c.add_argument("--table", required=True)
    c.add_argument("--profile", required=True)
    c.add_argument("--set", action="append", default=[], metavar="SECTION.KEY=VALUE")
    c.add_argument("--embedder", help="module:attribute; the configured service unless given")
    c.add_argument("--out", help="table of outcomes and vectors")
    c.add_argument("--max-rows", type=int)
    c.add_argument("--workers", type=int, default=8)
    c.add_argument("--dry-run", action="store_true")
    c.add_argument("--yes", action="store_true", help="confirm a run over all rows")
    c = commands.add_parser("stats", help="documents of the log by status")
    c.add_argument("--log", required=True)
    return top


def _ingest(spark: SparkSession, a: argparse.Namespace) -> dict:
    extensions = a.extension or ([".pdf"] if a.root else ["." + a.file.rsplit(".", 1)[-1]])
    log = sinks.ensure(spark, a.log, schema.INGESTION_LOG)
    root = a.root or a.file
    found = files.crawl(spark, root, extensions, with_hash=True, most=a.max_files).withColumn("readable", F.lit(True))
    if a.dry_run:
        return ledger.crawl_stats(ledger.decide(found, log, force=a.force)).first().asDict(recursive=True)
    got = pipelines.ingest(found, files.contents(spark, root, found, extensions), log, plug_in(a.parser), pipelines.Providers(plug_in(a.embedder)), a.dimensions, F.current_timestamp(), force=a.force)
    chunks = sinks.ensure(spark, a.chunks, schema.CHUNKS)
    fresh = got.chunks.withColumns({"created_at": F.current_timestamp(), "updated_at": F.current_timestamp()}).select(chunks.columns)
    sinks.replace(sinks.replace_documents(chunks, fresh, ["doc_id"]), a.chunks)
    sinks.replace(got.log.select([c for c in log.columns if c in got.log.columns]), a.log)
    return {r["status"]: r["docs"] for r in jobs.pipeline_stats(sinks.ensure(spark, a.log, schema.INGESTION_LOG)).collect()}


def _backfill(spark: SparkSession, a: argparse.Namespace, settings: config.Settings) -> dict:
    p = profile.load(a.profile, a.set)
    source, how = p["existing_chunks"], p["embedding"]
    table = spark.read.parquet(a.table)
    key, text, vector = (source[k] for k in ("id_column", "text_column", "vector_column"))
    if a.dry_run:
        return {"eligible": pipelines.eligible(table, vector, how["reuse_existing"], a.max_rows)}
    if a.max_rows is None and not a.yes:
        raise SystemExit("a run over all rows needs --yes; try --dry-run or --max-rows first")
    if not a.out:
        raise SystemExit("--out is needed")
    dimensions = how.get("dimensions", int(settings.embedding.get("dimensions", 1536)))
    schema.validate_source(table, key, text, vector, dimensions)
    if a.embedder:
        provider = plug_in(a.embedder)
    else:
        service = settings.embedding
        provider = clients.HttpEmbedder(clients.Client(service["url"], (("api-key", service.get("api_key", "")),), float(how.get("timeout_seconds", 90))), how.get("model", service.get("model", "")), dimensions)
    calls = Calls(how.get("batch_size", 128), how.get("batch_tokens", 24_000), how.get("max_attempts", 5), how.get("rpm", 0), how.get("tpm", 0), a.workers)
    ids = pipelines.discover(table, key, vector, how["reuse_existing"], page=a.max_rows)
    done = pipelines.backfill(table, key, text, vector, provider, dimensions, how["reuse_existing"], calls, ids)
    done.write.parquet(a.out)
    return {r["outcome"]: r["n"] for r in jobs.run_summary(spark.read.parquet(a.out).withColumnRenamed("outcome", "o"), "o").withColumnRenamed("o", "outcome").collect()}


def _rechunk(spark: SparkSession, a: argparse.Namespace) -> dict:
    p = profile.load(a.profile, a.set)
    names = {"doc_id": "doc_id_column", "text": "text_column", "page": "page_column", "position": "position_column", "file_path": "file_path_column", "file_name": "file_name_column"}
    mapping = {k: p["extracted_content"][v] for k, v in names.items() if p["extracted_content"].get(v)}
    c = p["chunking"]
    policy = token_chunking.Policy(c["max_tokens"], c["min_tokens"], c["overlap_tokens"], c["preserve_headers"])
    tokenizer = token_chunking.RankTokenizer(a.ranks, token_chunking.PATTERNS[c["tokenizer"]]) if a.ranks else None
    chunks, failed = pipelines.rechunk_settling(spark.read.parquet(a.table), mapping, policy, p["metadata"], tokenizer)
    chunks.withColumn("profile_hash", F.lit(p["_fingerprint"])).write.parquet(a.out)
    return {"run": uuid.uuid4().hex, "chunks": spark.read.parquet(a.out).count(), "failed": failed.count(), "tokens": c["tokenizer"] if a.ranks else "words"}


def main(arguments: list[str] | None = None) -> int:
    a = build().parse_args(arguments)
    log = logs.set_up(a.log_file, a.log_json)
    settings = config.load(a.config)
    spark = session(master=a.master, **settings.spark)
    if a.command == "query":
        found: DataFrame = catalog.QUERIES[a.name](spark, a.data)
        if a.out:
            found.write.parquet(a.out)
        else:
            found.show(20, truncate=80)
        return 0
    run = {"ingest": lambda: _ingest(spark, a), "rechunk": lambda: _rechunk(spark, a), "backfill": lambda: _backfill(spark, a, settings), "stats": lambda: {r["status"]: r["docs"] for r in jobs.pipeline_stats(spark.read.parquet(a.log)).collect()}}
    try:
        print(json.dumps(run[a.command](), default=str))
    except providers.ProviderError as e:
        log.error("%s failed", a.command, extra={"error": str(e)})
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
