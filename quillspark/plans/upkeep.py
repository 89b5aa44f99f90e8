"""Queries on the upkeep of tables and jobs, on elements of pages, and on whole workloads."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import schema
from ..functions import status, vectors
from ..operators import chunking, jobs, layout, ledger, providers, retrieval, tables
from ..operators.batching import Calls
from ..sources import files, listing, sinks
from ..sources.commits import Tables, write_isolating
from ..sources.store import shared_folder, written_below
from . import pipelines
from .chunks import TRIM
from .registry import Registry
from .search import CHANGED, QUERY_ROW, TOP, _top, _vectors
from .standins import AS_OF, LOG, TASKS, as_of, log_rows, table, task_rows

REGISTRY = Registry()
query = REGISTRY.query


@query(f"WITH {TASKS} SELECT job_key, row_id, owner FROM tasks WHERE row_id % 3 <> 0 UNION ALL SELECT job_key, row_id, 'new' FROM tasks WHERE row_id % 3 = 0 AND row_id % 2 = 0")
def insert_ignore(spark, sf_dir):
    tasks = task_rows(spark, sf_dir).select("job_key", "row_id", "owner")
    return ledger.insert_ignore(tasks.where(F.pmod("row_id", F.lit(3)) != 0), tasks.where(F.pmod("row_id", F.lit(2)) == 0).withColumn("owner", F.lit("new")), ["job_key", "row_id"])


@query(f"WITH {TASKS} SELECT NOT EXISTS (SELECT 1 FROM tasks WHERE status IN ('PENDING', 'RUNNING')) all_done, NOT EXISTS (SELECT 1 FROM tasks WHERE row_id % 5 IN (1, 2) AND status IN ('PENDING', 'RUNNING')) some_done, FALSE discovering")
def job_completeness(spark, sf_dir):
    tasks = task_rows(spark, sf_dir)
    some = tasks.where(F.pmod("row_id", F.lit(5)).isin(1, 2))
    return spark.range(1).select(F.lit(ledger.is_complete(tasks, True)).alias("all_done"), F.lit(ledger.is_complete(some, True)).alias("some_done"), F.lit(ledger.is_complete(some, False)).alias("discovering"))


SAMPLES = f"{TASKS}, n AS (SELECT job_key, count(*) total, count(*) FILTER (status = 'SUCCESS') done, (epoch_us(max(updated_at)) - epoch_us(min(updated_at))) / 1e6 elapsed FROM tasks GROUP BY 1)"


@query(f"WITH {SAMPLES} SELECT job_key, round(done / elapsed, 9) per_second, round((total - done) / (done / elapsed), 3) seconds_left FROM n")
def eta(spark, sf_dir):
    us = F.unix_micros("updated_at")
    rows = task_rows(spark, sf_dir).groupBy("job_key").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "SUCCESS").alias("done"), ((F.max(us) - F.min(us)) / 1e6).alias("elapsed"))
    return jobs.eta(rows, F.col("total"), F.col("done"), F.col("elapsed")).select("job_key", F.round("per_second", 9).alias("per_second"), F.round("seconds_left", 3).alias("seconds_left"))


@query(f"WITH {TASKS}, j AS (SELECT job_key, epoch_us(max(updated_at)) created_at, count(*) FILTER (status = 'RUNNING' AND lease_until > TIMESTAMP '{AS_OF}' AND job_key < 'job15') active FROM tasks GROUP BY 1) SELECT * FROM j ORDER BY active > 0 DESC, created_at DESC, job_key LIMIT 7")
def dashboard_order(spark, sf_dir):
    live = (F.col("status") == "RUNNING") & (F.col("lease_until") > as_of()) & (F.col("job_key") < "job15")
    rows = task_rows(spark, sf_dir).groupBy("job_key").agg(F.unix_micros(F.max("updated_at")).alias("created_at"), F.count_if(live).alias("active"))
    return jobs.dashboard_order(rows).limit(7)


@query(f"WITH {TASKS} SELECT job_key, row_id, epoch_us(updated_at) occurred_us FROM tasks WHERE status = 'FAILED' ORDER BY updated_at DESC, row_id LIMIT 50")
def failure_history(spark, sf_dir):
    failed = task_rows(spark, sf_dir).where("status = 'FAILED'").withColumnRenamed("updated_at", "occurred_at")
    return jobs.recent_failures(failed, 50, "occurred_at").select("job_key", "row_id", F.unix_micros("occurred_at").alias("occurred_us"))


@query("SELECT conv_id, turn FROM conversations WHERE conv_id % 3 <> 1")
def delete_documents(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    return sinks.delete_documents(rows, rows.where(F.pmod("conv_id", F.lit(3)) == 1), "conv_id")


@query(f"WITH {LOG} SELECT doc_id, l_linenumber FROM (SELECT CAST(l_orderkey AS VARCHAR) doc_id, l_linenumber FROM lineitem) c WHERE doc_id IN (SELECT doc_id FROM log WHERE status = 'SUCCESS')")
def cascade(spark, sf_dir):
    chunks = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("doc_id"), "l_linenumber")
    return sinks.cascade(log_rows(spark, sf_dir).where("status = 'SUCCESS'"), chunks)


@query("""WITH c AS (SELECT conv_id doc_id, turn, conv_id % 2 = 0 fresh FROM conversations), a AS (SELECT doc_id, turn, CASE WHEN fresh THEN 'p2' ELSE 'p1' END profile_hash FROM c UNION ALL SELECT doc_id, turn, 'p1' FROM c WHERE fresh)
SELECT doc_id, profile_hash, CAST(count(*) AS INTEGER) chunk_count, count(*) chunks FROM a GROUP BY 1, 2""")
def save_profile_result(spark, sf_dir):
    """Results of one profile, then of another for half of the documents: both stay."""
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), "turn", F.lit("h").alias("source_hash"))
    chunks = rows.withColumn("profile_hash", F.lit("")).limit(0)
    results = spark.createDataFrame([], "doc_id long, profile_hash string, source_hash string, chunk_count int, updated_at timestamp")
    for profile, some in (("p1", rows), ("p2", rows.where(F.pmod("doc_id", F.lit(2)) == 0)), ("p2", rows.where(F.pmod("doc_id", F.lit(2)) == 0))):
        results, chunks = sinks.save_profile_result(results, chunks, some, profile, as_of())
    counts = chunks.groupBy("doc_id", "profile_hash").agg(F.count(F.lit(1)).alias("chunks"))
    return results.select("doc_id", "profile_hash", "chunk_count").join(counts, ["doc_id", "profile_hash"])


@query("SELECT DISTINCT source folder FROM documents WHERE source NOT IN (SELECT source FROM documents WHERE doc_id % 50 = 3)")
def unscanned_folders(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("folder"), "doc_id")
    return files.unscanned(docs.select("folder").distinct(), docs.where(F.pmod("doc_id", F.lit(50)) == 3).select("folder").distinct())


@query("SELECT sha256('s3://b/' || k) doc_id, 's3://b/' || k file_path, 'o' || o_orderkey || '.pdf' file_name, o_custkey file_size, md5(o_orderpriority) file_hash FROM (SELECT *, 'in/o' || o_orderkey || '.pdf' k FROM orders WHERE o_orderkey % 2 = 0)")
def store_listing(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    key = F.concat(F.lit("in/o"), F.col("o_orderkey").cast("string"), F.when(F.pmod("o_orderkey", F.lit(2)) == 0, ".pdf").otherwise(".txt"))
    listing = o.select(F.lit("b").alias("bucket"), key.alias("key"), F.concat(F.lit('"'), F.md5("o_orderpriority"), F.lit('"')).alias("etag"), F.col("o_custkey").alias("size"), F.col("o_orderdate").alias("last_modified"))
    return files.from_listing(listing).drop("last_modified")


@query(f"WITH {CHANGED}, {QUERY_ROW}, {TOP}, r AS (SELECT row_number() OVER (ORDER BY similarity DESC, vec_id) n, * FROM top) SELECT '[' || n || '] f' || label || ' p.' || label || '-' || (label + 1) || ' | — | ' || vec_id || ' | ' || printf('%.4f', similarity) citation FROM r")
def citations(spark, sf_dir):
    label, key = F.col("label").cast("string"), F.col("vec_id").cast("string")
    rows = _top(spark, sf_dir).select("similarity", F.concat(F.lit("f"), label).alias("file_name"), F.col("label").alias("page_start"), (F.col("label") + 1).alias("page_end"), F.lit("—").alias("section_title"), key.alias("chunk_id"), F.row_number().over(Window.orderBy(F.desc("similarity"), "vec_id")).alias("rank"))  # eight rows
    return retrieval.citations(rows, "rank")


@query("SELECT o_orderkey, CASE WHEN s < 60 THEN s || 's' WHEN s < 3600 THEN printf('%.0f', CAST(s AS DOUBLE) / 60) || 'm' ELSE s // 3600 || 'h' || lpad(CAST(s % 3600 // 60 AS VARCHAR), 2, '0') || 'm' END took FROM (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN o_custkey % 60 WHEN 1 THEN (o_custkey % 3500) // 60 * 60 + 61 ELSE o_custkey * 37 + 3600 END s FROM orders)")
def durations(spark, sf_dir):
    c, m = F.col("o_custkey"), F.pmod("o_orderkey", F.lit(3))
    seconds = F.when(m == 0, c % 60).when(m == 1, F.floor(c % 3500 / 60) * 60 + 61).otherwise(c * 37 + 3600)
    return table(spark, sf_dir, "orders").select("o_orderkey", status.duration(seconds).alias("took"))


@query(f"WITH {CHANGED} SELECT vec_id, '[' || array_to_string(list_transform(v, lambda x: printf('%.8f', CAST(x AS DOUBLE))), ',') || ']' as_text, TRUE same FROM e WHERE v IS NOT NULL")
def vector_text(spark, sf_dir):
    rows = _vectors(spark, sf_dir).where("v is not null").withColumn("as_text", vectors.to_text("v"))
    back = F.zip_with(vectors.from_text("as_text"), "v", lambda a, b: (F.abs(a - b) < 1e-6) | a.eqNullSafe(b))
    return rows.select("vec_id", "as_text", F.forall(back, lambda x: x).alias("same"))


@query("SELECT l_orderkey, coalesce(list_sort(s)[len(s) // 2 + 1], 12.0) size FROM (SELECT l_orderkey, coalesce(list(CAST(l_quantity AS DOUBLE)) FILTER (l_quantity > 10), []) s FROM lineitem GROUP BY 1)")
def median_sizes(spark, sf_dir):
    sizes = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.when(F.col("l_quantity") > 10, F.col("l_quantity").cast("double")).otherwise(F.lit(0.0))).alias("s"))
    return sizes.select("l_orderkey", layout.median_size(F.col("s")).alias("size"))


@query("SELECT conv_id doc_id, turn page, CASE WHEN turn % 2 = 0 AND conv_id % 3 > 0 THEN 'read ' || role ELSE text END AS text FROM conversations")
def pages_with_ocr(spark, sf_dir):
    pages = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page"), "text", "role")
    results = pages.where(F.pmod("page", F.lit(2)) == 0).select("doc_id", "page", F.concat(F.lit("read "), "role").alias("text"), (F.pmod("doc_id", F.lit(3)) > 0).alias("accepted"))
    return layout.with_ocr(pages.drop("role"), results)


#: Lines of a turn as elements of a page: every third is a table, and every fourth table has no text found for it.
ELEMENTS = """el AS (SELECT conv_id doc_id, turn page, CAST(i AS INTEGER) - 1 ordinal, CASE WHEN i % 3 = 0 THEN 'table' ELSE 'text' END kind, s[i] line FROM (SELECT conv_id, turn, string_split(text, chr(10)) s, unnest(range(1, len(string_split(text, chr(10))) + 1)) i FROM conversations)),
filled AS (SELECT doc_id, page, ordinal, kind, CASE WHEN kind = 'text' THEN line WHEN ordinal % 4 = 1 THEN '' ELSE 'T' || line || CASE WHEN ordinal % 4 = 2 THEN chr(10) || chr(10) || '[TABLE SUMMARY]' || chr(10) || 'sum' ELSE '' END END AS text FROM el)"""


def _elements(spark, sf_dir):
    lines = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page"), F.posexplode(F.split("text", "\n")).alias("ordinal", "text"))
    raw = lines.withColumn("kind", F.when(F.pmod(F.col("ordinal") + 1, F.lit(3)) == 0, "table").otherwise("text"))
    found = raw.where("kind = 'table'").withColumn("table_index", F.floor(F.col("ordinal") / 3)).where(F.pmod("ordinal", F.lit(4)) != 1)
    summary = F.when(F.pmod("ordinal", F.lit(4)) == 2, "sum")
    texts = found.select("doc_id", "page", "table_index", tables.best_text(F.concat(F.lit("T"), "text"), summary, F.lit("plain")).alias("best_text"))
    return tables.into_elements(raw.select("doc_id", "page", "ordinal", "kind", "text"), texts)


@query(f"WITH {ELEMENTS} SELECT doc_id, page, ordinal, kind, text FROM filled")
def table_elements(spark, sf_dir):
    return _elements(spark, sf_dir)


HEADING_SQL = r"^\s*(\d+(\.\d+){0,3}\s+[A-Z][^\n]{0,100}|[A-Z][A-Z\s\-]{3,50}|(SECTION|CHAPTER|ANNEX|APPENDIX|PART|SCHEDULE)\s+\w[^\n]{0,80}|(Executive Summary|Introduction|Conclusion|References|Background|Objectives?|Methods?|Results?|Discussion|Summary|Overview|Efficacy|Safety|Pharmacokinetics|Pharmacodynamics|Clinical|Preclinical|Regulatory|Administrative)[^\n]{0,80})\s*$"


@query(f"""WITH {ELEMENTS}, t AS (SELECT *, {TRIM.format('text')} x FROM filled)
SELECT doc_id, page, coalesce(string_agg(CASE WHEN kind = 'text' THEN x ELSE '[TABLE]' || chr(10) || x || chr(10) || '[/TABLE]' END, chr(10) ORDER BY ordinal) FILTER (x <> ''), '') AS text, coalesce(list_sort(list_distinct(list(kind) FILTER (x <> ''))), []) content_types,
  arg_min(x, ordinal) FILTER (kind = 'text' AND ordinal < 5 AND x <> '' AND length(x) <= 150 AND regexp_matches(x, '(?i){HEADING_SQL}')) heading FROM t GROUP BY 1, 2""")
def element_pages(spark, sf_dir):
    return chunking.pages_of(_elements(spark, sf_dir)).select("doc_id", "page", "text", "content_types", "heading")


@query("SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'SKIPPED/ALREADY_DONE' WHEN doc_id % 7 = 0 THEN 'SKIPPED/EMPTY_TEXT' WHEN greatest(1, length(text) // 4) > 3000 THEN 'FAILED/INPUT_TOO_LONG' WHEN contains(text, 'Licensed') THEN 'FAILED/API_FAILURE: no licences' ELSE 'SUCCESS' END outcome FROM documents")
def backfill_outcomes(spark, sf_dir):
    """Texts with a licence line are refused by the provider, and each is found alone."""
    m = lambda n: F.pmod("doc_id", F.lit(n)) == 0
    rows = table(spark, sf_dir, "documents").select("doc_id", F.when(m(7), "").otherwise(F.col("text")).alias("text"), F.when(m(5), F.array(F.lit(1.0).cast("float"))).alias("v"))
    calls = Calls(batch_size=16, batch_tokens=3000, workers=8)
    return pipelines.backfill(rows, "doc_id", "text", "v", providers.Refusing("Licensed", "no licences"), 8, calls=calls).select("doc_id", "outcome")


@query("""SELECT CAST(doc_id AS VARCHAR) doc_id, CASE WHEN doc_id % 6 = 0 THEN 'ERROR' WHEN length(t) < 150 THEN 'ERROR' ELSE 'SUCCESS' END status, CASE WHEN doc_id % 6 = 0 THEN 'broken file' WHEN length(t) < 150 THEN 'no chunks' END error_message,
  CASE WHEN doc_id % 6 = 0 THEN 0 ELSE 1 END pages_total FROM (SELECT doc_id, """ + TRIM.format("text") + " t FROM documents WHERE doc_id % 3 <> 1 AND n_chars > 0)")
def ingest_log(spark, sf_dir):
    """Documents as files of one page of text: every sixth cannot be read, those of the log are done."""
    docs = table(spark, sf_dir, "documents").where("n_chars > 0")
    key = F.col("doc_id").cast("string")
    found = docs.select(key.alias("doc_id"), F.concat(key, F.lit(".txt")).alias("file_name"), F.concat(F.lit("/in/"), key).alias("file_path"), F.md5("text").alias("file_hash"), F.octet_length("text").cast("long").alias("file_size"), as_of().alias("last_modified"), F.lit(True).alias("readable"), F.pmod("doc_id", F.lit(3)).alias("m"))
    log = found.where("m = 1").select("doc_id", "file_path", "file_name", "file_hash", "file_size", "last_modified", F.lit("SUCCESS").alias("status"), F.lit(None).cast("string").alias("error_message"), F.lit(0).alias("retry_count"), F.lit(1).alias("chunk_count"), F.lit(1).alias("pages_total"), as_of().alias("ingested_at"), as_of().alias("updated_at"))
    contents = docs.select(key.alias("doc_id"), F.encode(F.when(F.pmod("doc_id", F.lit(6)) == 0, "").otherwise(F.col("text")), "utf-8").alias("content"))
    got = pipelines.ingest(found.drop("m"), contents, log, providers.PlainTextParser(), pipelines.Providers(providers.HashEmbedder(8)), 8, as_of())
    return got.log.join(found.where("m <> 1").select("doc_id"), "doc_id", "left_semi").select("doc_id", "status", "error_message", "pages_total")


@query("SELECT o_orderkey, concat_ws(' · ', CASE WHEN o_orderkey % 2 = 0 THEN 'p' || o_orderkey % 5 END, CASE WHEN o_orderkey % 3 = 0 THEN 'Older job · target unlabeled' ELSE 's.t' || o_orderkey % 7 END, left(md5(CAST(o_orderkey AS VARCHAR)), 12), CASE WHEN o_custkey % 4 > 0 THEN 'pilot ≤' || format('{:,}', o_custkey % 4 * 1234) END) job_label FROM orders")
def job_labels(spark, sf_dir):
    o, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    m = lambda n: F.pmod(key, F.lit(n))
    source = F.when(m(3) > 0, F.concat(F.lit("t"), m(7).cast("string")))
    return o.select("o_orderkey", jobs.label(F.when(m(2) == 0, F.concat(F.lit("p"), m(5).cast("string"))), F.when(m(3) > 0, "s"), source, F.md5(key.cast("string")), F.pmod("o_custkey", F.lit(4)) * 1234).alias("job_label"))


@query("SELECT o_orderkey doc_id FROM orders WHERE NOT (o_orderkey % 4 = 0 AND o_orderkey % 3 <> 0 AND o_orderkey % 5 <> 0)")
def unlocked_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"))
    m = lambda n: F.pmod("doc_id", F.lit(n)) == 0
    until = F.when(m(5), as_of() - F.expr("interval 1 hour")).otherwise(as_of() + F.expr("interval 1 hour"))
    return ledger.unlocked(docs, docs.where(m(4)).select("doc_id", F.when(m(3), "me").otherwise("other").alias("owner"), until.alias("until")), "me", as_of())


@query(f"WITH {CHANGED}, {QUERY_ROW}, {TOP}, r AS (SELECT row_number() OVER (ORDER BY similarity DESC, vec_id) n, * FROM top) SELECT '[' || string_agg('{{\"rank\":' || n || ',\"chunk_id\":\"' || vec_id || '\",\"label\":' || label || '}}', ',' ORDER BY n) || ']' AS json FROM r".replace("{{", "{").replace("}}", "}"))
def results_json(spark, sf_dir):
    rows = _top(spark, sf_dir).select(F.row_number().over(Window.orderBy(F.desc("similarity"), "vec_id")).alias("rank"), F.col("vec_id").cast("string").alias("chunk_id"), "label")  # eight rows
    return retrieval.as_json(rows, ["chunk_id", "label"])


@query("""WITH d AS (SELECT o_orderkey doc_id, o_orderkey % 4 = 0 held, CASE WHEN o_orderkey % 3 = 0 THEN 'me' ELSE 'other' END owner, o_orderkey % 5 <> 0 valid FROM orders)
SELECT CAST(doc_id AS VARCHAR) doc_id, CASE WHEN doc_id % 2 = 0 AND (NOT held OR owner = 'me' OR NOT valid) THEN 'me' ELSE owner END owner, CASE WHEN doc_id % 2 = 0 AND (NOT held OR owner = 'me' OR NOT valid) THEN 600 WHEN valid THEN 3600 ELSE -3600 END AS "seconds" FROM d WHERE held OR doc_id % 2 = 0""")
def document_locks(spark, sf_dir):
    """Locks after an owner has asked for every other document."""
    docs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("doc_id"), "o_orderkey")
    m = lambda n: F.pmod("o_orderkey", F.lit(n)) == 0
    until = F.when(m(5), as_of() - F.expr("interval 1 hour")).otherwise(as_of() + F.expr("interval 1 hour"))
    locks = docs.where(m(4)).select("doc_id", F.when(m(3), "me").otherwise("other").alias("owner"), until.alias("until"))
    got = ledger.take_locks(locks, docs.where(m(2)), "me", as_of(), 600)
    return got.select("doc_id", "owner", (F.unix_seconds("until") - F.unix_seconds(as_of())).cast("int").alias("seconds"))


@query("""WITH c AS (SELECT CAST(conv_id AS VARCHAR) doc_id, turn, conv_id % 2 = 0 fresh FROM conversations), a AS (SELECT doc_id, turn, CASE WHEN fresh THEN 'p2' ELSE 'p1' END profile_hash FROM c UNION ALL SELECT doc_id, turn, 'p1' FROM c WHERE fresh)
SELECT doc_id, profile_hash, CAST(count(*) AS INTEGER) chunk_count, count(*) chunks FROM a GROUP BY 1, 2""")
def committed_results(spark, sf_dir):
    """Results and chunks of two profiles, each in one commit; the second batch is sent twice."""
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("doc_id"), "turn", F.lit("h").alias("source_hash"))
    tables = Tables(spark, shared_folder(spark, "results"), {"results": schema.PROFILE_RESULTS, "chunks": "doc_id string, turn long, profile_hash string, source_hash string"})
    half = rows.where(F.pmod(F.col("doc_id").cast("long"), F.lit(2)) == 0)
    for n, profile, some in ((0, "p1", rows), (1, "p2", half), (1, "p2", half.unionAll(half))):
        tables.save_profile_result(some, profile, as_of(), "results", n)
    counts = tables.read("chunks").groupBy("doc_id", "profile_hash").agg(F.count(F.lit(1)).alias("chunks"))
    return tables.read("results").select("doc_id", "profile_hash", "chunk_count").join(counts, ["doc_id", "profile_hash"])


@query("SELECT event_id, event_type FROM events WHERE event_id <> 417")
def isolated_commits(spark, sf_dir):
    """Rows of which one cannot be written: the others are committed by halves."""
    rows = table(spark, sf_dir, "events").select("event_id", "event_type")
    tables = Tables(spark, shared_folder(spark, "isolated"), {"events": "event_id long, event_type string"})
    poison = F.when(F.col("event_id") == 417, F.raise_error(F.lit("cannot be written"))).otherwise(F.col("event_type"))
    write_isolating(rows, "event_id", lambda part: tables.append("events", part.withColumn("event_type", poison)))
    return tables.read("events")


@query("SELECT 'in/' || source || '/' || doc_id || '.pdf' AS key, octet_length(encode(coalesce(text, ''))) size FROM documents")
def listed_prefixes(spark, sf_dir):
    """Documents written below a folder for each source, and listed by a task for each folder."""
    docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("in/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("key"), F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("content"))
    root = written_below(docs, "store")
    return listing.store_listing(spark, root, depth=2).select("key", "size")
