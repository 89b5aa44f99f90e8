"""Queries on coverage, jobs and the ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import status, text
from ..operators import jobs, ledger, rollup
from ..sources import files
from .registry import Registry
from .standins import AS_OF, CHUNKS, FILES, LOG, TASKS, as_of, chunk_rows, file_rows, log_rows, table, task_rows, with_

REGISTRY = Registry()
query = REGISTRY.query


def _documents(spark, sf_dir):
    c = chunk_rows(spark, sf_dir)
    return rollup.per_document(c, F.col("doc_id"), F.col("embedded"), F.col("noted"), F.col("file_name"), F.col("updated"))


DOCUMENTS = """docs AS (SELECT nullif(trim(doc_id), '') doc_id, count(*) chunks, count(*) FILTER (embedded) embedded, count(*) FILTER (NOT embedded AND noted) noted,
  min(file_name) file_name, max(updated) last_update FROM chunks GROUP BY 1)"""


@query(with_(CHUNKS, DOCUMENTS) + "SELECT * FROM docs")
def doc_rollup(spark, sf_dir):
    return _documents(spark, sf_dir)


TOTALS = """SELECT count(*) FILTER (doc_id IS NOT NULL) total_documents, count(*) FILTER (doc_id IS NOT NULL AND embedded >= chunks) completed,
  count(*) FILTER (doc_id IS NOT NULL AND embedded > 0 AND embedded < chunks) partial, count(*) FILTER (doc_id IS NOT NULL AND embedded = 0) untouched,
  count(*) FILTER (doc_id IS NOT NULL AND noted > 0) attention, CAST(coalesce(sum(chunks), 0) AS BIGINT) total_chunks, CAST(coalesce(sum(embedded), 0) AS BIGINT) embedded_chunks,
  CAST(coalesce(sum(chunks - embedded), 0) AS BIGINT) missing_chunks, CAST(coalesce(sum(chunks) FILTER (doc_id IS NULL), 0) AS BIGINT) unmapped_chunks FROM docs"""


@query(with_(CHUNKS, DOCUMENTS) + TOTALS)
def doc_totals(spark, sf_dir):
    return rollup.totals(_documents(spark, sf_dir))


@query(with_(CHUNKS, DOCUMENTS) + "SELECT doc_id, chunks, embedded, chunks - embedded AS missing FROM docs WHERE doc_id IS NOT NULL AND chunks > embedded ORDER BY missing DESC, doc_id LIMIT 25")
def doc_priority_top25(spark, sf_dir):
    return rollup.priorities(_documents(spark, sf_dir)).select("doc_id", "chunks", "embedded", "missing")


@query(with_(CHUNKS, DOCUMENTS) + "SELECT doc_id, file_name, chunks, embedded, chunks - embedded AS missing, round(100.0 * embedded / chunks, 1) coverage_pct, noted FROM docs WHERE doc_id IS NOT NULL AND chunks > embedded ORDER BY missing DESC, doc_id LIMIT 25")
def shown_priorities(spark, sf_dir):
    return rollup.shown_priorities(rollup.priorities(_documents(spark, sf_dir)))


@query(with_(CHUNKS, DOCUMENTS) + "SELECT doc_id, CASE WHEN chunks <= 0 THEN 'Unknown' WHEN embedded >= chunks THEN 'Complete' WHEN embedded > 0 THEN 'Partial' ELSE 'Not started' END stage, round(100.0 * embedded / chunks, 1) coverage_pct FROM docs")
def doc_stage(spark, sf_dir):
    return rollup.with_stage(_documents(spark, sf_dir)).select("doc_id", "stage", "coverage_pct")


@query(with_(CHUNKS, DOCUMENTS, "top AS (SELECT chunks - embedded missing, doc_id, chunks, embedded FROM docs WHERE doc_id IS NOT NULL AND chunks > embedded ORDER BY 1 DESC, 2 LIMIT 25)") + f"SELECT t.*, (SELECT '[' || string_agg('{{\"missing\":' || missing || ',\"doc_id\":\"' || doc_id || '\",\"chunks\":' || chunks || ',\"embedded\":' || embedded || '}}', ',' ORDER BY missing DESC, doc_id) || ']' FROM top) priorities FROM ({TOTALS}) t")
def doc_totals_json(spark, sf_dir):
    return rollup.totals_with_priorities(_documents(spark, sf_dir))


WANTED = "7"


@query(with_(CHUNKS, f"own AS (SELECT * FROM chunks WHERE trim(doc_id) = '{WANTED}')") + "SELECT chunk_index, chunk_id, embedded, updated, (SELECT count(*) > 200 FROM own) truncated FROM own ORDER BY chunk_index NULLS LAST, chunk_id LIMIT 200")
def doc_details(spark, sf_dir):
    return rollup.details(chunk_rows(spark, sf_dir), F.col("doc_id"), WANTED, F.col("chunk_index"), F.col("chunk_id"), {"embedded": F.col("embedded"), "updated": F.col("updated")})


@query(with_(CHUNKS) + f"SELECT count(*) chunks, count(*) FILTER (embedded) embedded, max(chunk_index) declared_total, count(*) FILTER (NOT embedded AND noted) noted FROM chunks WHERE trim(doc_id) = '{WANTED}'")
def doc_summary(spark, sf_dir):
    return rollup.single_summary(chunk_rows(spark, sf_dir), F.col("doc_id"), WANTED, F.col("embedded"), F.col("noted"), F.col("chunk_index"))


@query(with_(LOG) + "SELECT status, count(*) docs, CAST(sum(chunk_count) AS BIGINT) chunks, CAST(sum(pages_total) AS BIGINT) pages FROM log GROUP BY status")
def pipeline_stats(spark, sf_dir):
    return jobs.pipeline_stats(log_rows(spark, sf_dir))


@query(with_(LOG) + "SELECT status, count(*) docs, round(avg(pages_total), 1) avg_pages, epoch_us(max(ingested_at)) last_ingest_us FROM log GROUP BY status")
def status_health(spark, sf_dir):
    return jobs.status_health(log_rows(spark, sf_dir)).select("status", "docs", "avg_pages", F.unix_micros("last_ingest").alias("last_ingest_us"))


@query(with_(TASKS) + "SELECT job_key, status, count(*) n FROM tasks GROUP BY 1, 2")
def task_counts(spark, sf_dir):
    return jobs.task_counts(task_rows(spark, sf_dir))


PIVOT = "SELECT job_key, count(*) FILTER (status = 'PENDING') pending, count(*) FILTER (status = 'RUNNING') running, count(*) FILTER (status = 'SUCCESS') success, count(*) FILTER (status = 'FAILED') failed, count(*) FILTER (status = 'SKIPPED') skipped FROM tasks GROUP BY job_key"
ACTIVE = f"SELECT * FROM tasks WHERE status = 'RUNNING' AND lease_until > TIMESTAMP '{AS_OF}'"


def _jobs(spark, sf_dir):
    u = F.pmod("user_id", F.lit(25))
    rows = table(spark, sf_dir, "events").groupBy(F.concat(F.lit("job"), u.cast("string")).alias("job_key")).agg(F.min(F.col("ts").cast("timestamp")).alias("created_at"))
    return rows.withColumn("discovery_done", ~F.col("job_key").endswith("3"))


JOBS = "jobs AS (SELECT 'job' || CAST(user_id % 25 AS VARCHAR) job_key, min(ts) created_at, NOT ends_with('job' || CAST(user_id % 25 AS VARCHAR), '3') discovery_done FROM events GROUP BY 1)"
SUMMARY = f"""s AS (SELECT j.*, coalesce(pending, 0) pending, coalesce(running, 0) running, coalesce(success, 0) success, coalesce(failed, 0) failed, coalesce(skipped, 0) skipped, coalesce(active, 0) active
  FROM jobs j LEFT JOIN ({PIVOT}) p USING (job_key) LEFT JOIN (SELECT job_key, count(*) active FROM ({ACTIVE}) GROUP BY 1) a USING (job_key))"""
PHASE = """SELECT job_key, pending, running, success, failed, skipped, active, CASE WHEN active > 0 THEN 'Active claims' WHEN NOT discovery_done THEN 'Discovering / awaiting worker' WHEN pending + running > 0 THEN 'Pending / no active lease'
  WHEN failed > 0 THEN 'Completed with failures' WHEN success + skipped > 0 THEN 'Completed' ELSE 'No tasks discovered' END phase,
  CASE WHEN pending + running + success + failed + skipped > 0 THEN CAST(success + failed + skipped AS DOUBLE) / (pending + running + success + failed + skipped) ELSE 0.0 END progress FROM s"""


@query(with_(TASKS, JOBS, SUMMARY) + PHASE)
def job_status_pivot(spark, sf_dir):
    return jobs.summaries(_jobs(spark, sf_dir), task_rows(spark, sf_dir), as_of())


@query(with_(TASKS) + f"SELECT job_key, owner, count(*) claims, epoch_us(max(lease_until)) last_lease_us, CAST(grouping(owner) AS INTEGER) is_total FROM ({ACTIVE}) GROUP BY GROUPING SETS ((job_key, owner), (job_key))")
def claims_by_owner(spark, sf_dir):
    return jobs.claims_by_owner(task_rows(spark, sf_dir), as_of()).select("job_key", "owner", "claims", F.unix_micros("last_lease").alias("last_lease_us"), "is_total")


@query(with_(TASKS) + "SELECT coalesce(error_code, 'UNKNOWN') reason, count(*) n FROM tasks WHERE status = 'FAILED' GROUP BY 1")
def failure_reasons(spark, sf_dir):
    return jobs.failure_reasons(task_rows(spark, sf_dir).where("status = 'FAILED'"))


@query(with_(TASKS) + "SELECT job_key, row_id, error_code, left(error_message, 400) error_message FROM tasks WHERE status = 'FAILED' ORDER BY updated_at DESC, row_id LIMIT 200")
def recent_failures(spark, sf_dir):
    return jobs.recent_failures(task_rows(spark, sf_dir).where("status = 'FAILED'"), 999).select("job_key", "row_id", "error_code", "error_message")


@query(with_(TASKS, JOBS) + f"SELECT j.job_key, coalesce(tasks, 0) tasks, coalesce(pending, 0) pending, coalesce(running, 0) running, coalesce(success, 0) success, coalesce(failed, 0) failed, coalesce(skipped, 0) skipped FROM jobs j LEFT JOIN ({PIVOT}) p USING (job_key) LEFT JOIN (SELECT job_key, count(*) tasks FROM tasks GROUP BY 1) t USING (job_key)")
def runs_left_join_tasks(spark, sf_dir):
    return jobs.runs_with_tasks(_jobs(spark, sf_dir), task_rows(spark, sf_dir))


@query(with_(JOBS) + "SELECT job_key, epoch_us(created_at) created_us FROM jobs ORDER BY created_at DESC, job_key LIMIT 30")
def latest_jobs(spark, sf_dir):
    return jobs.latest_jobs(_jobs(spark, sf_dir), 9999).select("job_key", F.unix_micros("created_at").alias("created_us"))


@query(with_(LOG) + "SELECT status, count(*) n, round(100.0 * count(*) / sum(count(*)) OVER (), 1) pct FROM log GROUP BY status")
def run_summary(spark, sf_dir):
    return jobs.run_summary(log_rows(spark, sf_dir), "status")


@query("""WITH s AS (SELECT user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) done FROM events)
SELECT user_id, done, round(greatest(0.0, (done - lag(done) OVER w) * 60.0 / ((epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1e6)), 6) per_minute FROM s WINDOW w AS (PARTITION BY user_id ORDER BY ts, done)""")
def rate_per_minute(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    samples = table(spark, sf_dir, "events").select("user_id", "ts", F.row_number().over(w).cast("long").alias("done"))
    return jobs.rates(samples, "user_id", "ts", "done").select("user_id", "done", F.round("per_minute", 6).alias("per_minute"))


@query(with_(LOG) + "SELECT doc_id, CASE WHEN status = 'RUNNING' AND updated_at < TIMESTAMP '1998-01-01' - INTERVAL 60 MINUTE THEN 'PENDING' ELSE status END status, coalesce(status = 'RUNNING' AND updated_at < TIMESTAMP '1998-01-01' - INTERVAL 60 MINUTE, FALSE) was_stale FROM log")
def stale_reset(spark, sf_dir):
    return ledger.stale_reset(log_rows(spark, sf_dir), F.lit("1998-01-01").cast("timestamp")).select("doc_id", "status", "was_stale")


LADDER = """d AS (SELECT f.*, CASE WHEN NOT readable THEN 'not_readable' WHEN file_size <= 0 THEN 'empty_file'
  WHEN l.status = 'SUCCESS' AND abs(modified_us - epoch_us(l.last_modified)) <= 2000000 THEN 'unchanged'
  WHEN l.doc_id IS NULL THEN 'new_file' WHEN l.status = 'ERROR' AND l.retry_count >= 2 THEN 'max_retries_exceeded (' || l.retry_count || ')' WHEN l.status = 'RUNNING' THEN 'already_running'
  WHEN l.status = 'SUCCESS' AND l.file_hash = f.file_hash THEN 'unchanged' WHEN l.file_hash IS DISTINCT FROM f.file_hash THEN 'file_modified' WHEN l.status IN ('PENDING', 'ERROR') THEN 'retry (status=' || l.status || ')' ELSE 'skip' END reason
  FROM files f LEFT JOIN log l USING (doc_id))"""
TAKES = "(reason IN ('new_file', 'file_modified') OR starts_with(reason, 'retry'))"


def _decided(spark, sf_dir):
    return ledger.decide(file_rows(spark, sf_dir), log_rows(spark, sf_dir))


@query(with_(LOG, FILES, LADDER) + f"SELECT doc_id, reason, {TAKES} should_process FROM d")
def should_ingest(spark, sf_dir):
    return _decided(spark, sf_dir).select("doc_id", "reason", "should_process")


@query(with_(LOG, FILES, LADDER) + f"""SELECT count(*) found, count(*) FILTER ({TAKES}) to_process, count(*) FILTER (reason = 'unchanged') unchanged, count(*) FILTER (reason = 'not_readable') errors,
  CAST(sum(CASE WHEN {TAKES} THEN file_size ELSE 0 END) AS BIGINT) bytes_to_read, CAST(sum(CASE WHEN NOT {TAKES} THEN file_size ELSE 0 END) AS BIGINT) bytes_avoided,
  count(*) FILTER (lower(file_path) LIKE '%.pdf') pdf, count(*) FILTER (lower(file_path) LIKE '%.txt') txt FROM d""")
def crawl_stats(spark, sf_dir):
    got = ledger.crawl_stats(_decided(spark, sf_dir))
    return got.select("found", "to_process", "unchanged", "errors", "bytes_to_read", "bytes_avoided", F.col("by_extension")[".pdf"].alias("pdf"), F.col("by_extension")[".txt"].alias("txt"))


@query(with_(LOG, FILES, LADDER) + f"SELECT doc_id, file_size FROM d WHERE {TAKES}")
def work_queue(spark, sf_dir):
    return files.work_queue(_decided(spark, sf_dir)).select("doc_id", "file_size")


@query(with_(LOG, FILES) + "SELECT f.doc_id, coalesce(abs(modified_us - epoch_us(l.last_modified)) <= 2000000, FALSE) same_time FROM files f LEFT JOIN log l USING (doc_id)")
def mtime_tolerance(spark, sf_dir):
    old = log_rows(spark, sf_dir).select("doc_id", F.col("last_modified").alias("old"))
    rows = file_rows(spark, sf_dir).join(old, "doc_id", "left")
    return rows.select("doc_id", status.times_match(F.col("last_modified"), F.col("old")).alias("same_time"))


@query(with_(TASKS, "found AS (SELECT DISTINCT job_key, row_id + CASE WHEN row_id % 2 = 0 THEN 0 ELSE 10000000 END row_id FROM tasks)") + "SELECT coalesce(t.job_key, f.job_key) job_key, coalesce(t.row_id, f.row_id) row_id, CASE WHEN t.status IS NULL OR (f.row_id IS NOT NULL AND t.status IN ('SUCCESS', 'SKIPPED')) THEN 'PENDING' ELSE t.status END status FROM tasks t FULL JOIN found f ON t.job_key = f.job_key AND t.row_id = f.row_id")
def requeue_upsert(spark, sf_dir):
    tasks = task_rows(spark, sf_dir)
    found = tasks.select("job_key", (F.col("row_id") + F.when(F.pmod("row_id", F.lit(2)) == 0, 0).otherwise(10_000_000)).alias("row_id"))
    return ledger.enqueue(tasks.select("job_key", "row_id", "status"), found)


@query(with_(TASKS, f"c AS (SELECT job_key, row_id FROM tasks WHERE status = 'PENDING' OR (status = 'RUNNING' AND lease_until < TIMESTAMP '{AS_OF}') ORDER BY row_id LIMIT 100)") + f"SELECT t.job_key, t.row_id, CASE WHEN c.row_id IS NOT NULL THEN 'RUNNING' ELSE status END status, CASE WHEN c.row_id IS NOT NULL THEN 'me' ELSE owner END owner, CAST(1 + CASE WHEN c.row_id IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) attempts, epoch_us(CASE WHEN c.row_id IS NOT NULL THEN TIMESTAMP '{AS_OF}' + INTERVAL 300 SECOND ELSE lease_until END) lease_us FROM tasks t LEFT JOIN c USING (job_key, row_id)")
def claim_batch(spark, sf_dir):
    got = ledger.claim(task_rows(spark, sf_dir), "me", "t1", as_of(), 300, 100)
    return got.select("job_key", "row_id", "status", "owner", "attempts", F.unix_micros("lease_until").alias("lease_us"))


@query(with_(TASKS) + f"SELECT job_key, row_id, epoch_us(CASE WHEN status = 'RUNNING' AND owner = 'w3' AND row_id % 10 <> 0 THEN TIMESTAMP '{AS_OF}' + INTERVAL 90 SECOND ELSE lease_until END) lease_us FROM tasks")
def renew_leases(spark, sf_dir):
    tasks = task_rows(spark, sf_dir)
    got = ledger.renew(tasks, "w3", as_of(), 90, tasks.where(F.pmod("row_id", F.lit(10)) == 0))
    return got.select("job_key", "row_id", F.unix_micros("lease_until").alias("lease_us"))


RESULT = "r AS (SELECT job_key, row_id, CASE WHEN row_id % 4 = 0 THEN 'stale' ELSE 't0' END token, CASE WHEN row_id % 3 = 0 THEN 'FAILED' ELSE 'SUCCESS' END s FROM tasks WHERE row_id % 10 < 7)"


def _results(tasks):
    m = lambda n: F.pmod("row_id", F.lit(n))
    failed = m(3) == 0
    return tasks.where(m(10) < 7).select("job_key", "row_id", F.when(m(4) == 0, "stale").otherwise("t0").alias("claim_token"), F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"), F.when(failed, "API_FAILURE").alias("code"), F.when(failed, "HTTP 400").alias("message"))


@query(with_(TASKS, RESULT) + "SELECT t.job_key, t.row_id, CASE WHEN status = 'RUNNING' AND r.token = 't0' THEN r.s ELSE status END status, CASE WHEN status = 'RUNNING' AND r.token = 't0' THEN CASE WHEN r.s = 'FAILED' THEN 'API_FAILURE' END ELSE error_code END error_code FROM tasks t LEFT JOIN r USING (job_key, row_id)")
def fenced_finish(spark, sf_dir):
    tasks = task_rows(spark, sf_dir)
    return ledger.finish(tasks, _results(tasks), as_of())[0].select("job_key", "row_id", "status", "error_code")


@query(with_(TASKS, RESULT) + "SELECT t.job_key, t.row_id, 'API_FAILURE' error_code, 'API_FAILURE: HTTP 400' note FROM tasks t JOIN r USING (job_key, row_id) WHERE status = 'RUNNING' AND r.token = 't0' AND r.s = 'FAILED'")
def failure_events(spark, sf_dir):
    tasks = task_rows(spark, sf_dir)
    return ledger.finish(tasks, _results(tasks), as_of())[1].select("job_key", "row_id", "error_code", "note")


@query(with_(TASKS) + "SELECT job_key, row_id, CASE WHEN status = 'FAILED' THEN 'PENDING' WHEN status = 'RUNNING' AND owner = 'w2' THEN 'PENDING' ELSE status END status FROM tasks")
def requeue_and_release(spark, sf_dir):
    return ledger.release(ledger.requeue_failed(task_rows(spark, sf_dir)), "w2").select("job_key", "row_id", "status")


@query(with_(LOG) + f"""SELECT coalesce(l.doc_id, c.doc_id) doc_id, CASE WHEN c.doc_id IS NOT NULL THEN 'ERROR' ELSE l.status END status, CAST(CASE WHEN l.doc_id IS NULL THEN 0 ELSE l.retry_count + CASE WHEN c.inc THEN 1 ELSE 0 END END AS INTEGER) retry_count,
  epoch_us(CASE WHEN l.doc_id IS NULL THEN TIMESTAMP '{AS_OF}' ELSE l.ingested_at END) ingested_us, epoch_us(CASE WHEN c.doc_id IS NOT NULL THEN TIMESTAMP '{AS_OF}' ELSE l.updated_at END) updated_us
  FROM log l FULL JOIN (SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'n' ELSE '' END || CAST(o_orderkey AS VARCHAR) doc_id, o_orderkey % 3 = 0 inc FROM orders WHERE o_orderkey % 5 = 0) c ON l.doc_id = c.doc_id""")
def upsert_log(spark, sf_dir):
    key = F.col("o_orderkey")
    changes = table(spark, sf_dir, "orders").where(F.pmod(key, F.lit(5)) == 0).select(F.when(F.pmod(key, F.lit(2)) == 0, F.concat(F.lit("n"), key.cast("string"))).otherwise(key.cast("string")).alias("doc_id"), F.lit("ERROR").alias("status"), (F.pmod(key, F.lit(3)) == 0).alias("increment_retry"))
    got = ledger.upsert_log(log_rows(spark, sf_dir), changes, as_of())
    return got.select("doc_id", "status", "retry_count", F.unix_micros("ingested_at").alias("ingested_us"), F.unix_micros("updated_at").alias("updated_us"))


@query(with_(LOG) + "SELECT doc_id, epoch_us(updated_at) updated_us FROM log WHERE status = 'ERROR'")
def failed_documents(spark, sf_dir):
    return ledger.failed_documents(log_rows(spark, sf_dir)).select("doc_id", F.unix_micros("updated_at").alias("updated_us"))


@query(with_(LOG, FILES) + "SELECT doc_id, f.file_hash FROM log l JOIN files f USING (doc_id) WHERE l.status = 'ERROR' AND f.readable")
def retry_queue(spark, sf_dir):
    return ledger.retry_queue(log_rows(spark, sf_dir), file_rows(spark, sf_dir)).select("doc_id", "file_hash")


@query(with_(FILES, "f2 AS (SELECT '/in/' || (file_size // 10 % 40) || '/' || doc_id || CASE WHEN ends_with(file_path, '.pdf') THEN '.pdf' ELSE right(file_path, 4) END p, * FROM files)") + """SELECT regexp_replace(p, '/[^/]*$', '') folder, count(*) files, CAST(sum(file_size) AS BIGINT) bytes, count(*) FILTER (lower(p) LIKE '%.pdf') pdf_files, CAST(coalesce(sum(file_size) FILTER (lower(p) LIKE '%.pdf'), 0) AS BIGINT) pdf_bytes,
  count(*) FILTER (lower(p) LIKE '%.xml') xml_files, CAST(coalesce(sum(file_size) FILTER (lower(p) LIKE '%.xml'), 0) AS BIGINT) xml_bytes, count(*) FILTER (lower(p) LIKE '%.txt') other_files, CAST(coalesce(sum(file_size) FILTER (lower(p) LIKE '%.txt'), 0) AS BIGINT) other_bytes, max(modified_us) last_us FROM f2 GROUP BY 1""")
def folder_summary(spark, sf_dir):
    rows = file_rows(spark, sf_dir)
    folder = F.pmod(F.floor(F.col("file_size") / 10), F.lit(40)).cast("string")
    moved = rows.withColumn("file_path", F.concat(F.lit("/in/"), folder, F.lit("/"), "doc_id", F.right("file_path", F.lit(4))))
    return files.folder_summary(moved).select("folder", "files", "bytes", "pdf_files", "pdf_bytes", "xml_files", "xml_bytes", "other_files", "other_bytes", F.unix_micros("last_modified").alias("last_us"))


@query(with_(LOG) + "SELECT doc_id FROM log l WHERE NOT EXISTS (SELECT 1 FROM (SELECT doc_id, file_hash FROM log WHERE retry_count <> 1) r WHERE r.doc_id = l.doc_id AND r.file_hash = l.file_hash)")
def not_current(spark, sf_dir):
    docs = log_rows(spark, sf_dir).select("doc_id", F.col("file_hash").alias("source_hash"), F.lit("p").alias("profile_hash"), "retry_count")
    return ledger.not_current(docs.drop("retry_count"), docs.where("retry_count <> 1").drop("retry_count")).select("doc_id")


@query("SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'SKIPPED/MISSING' WHEN doc_id % 5 = 0 THEN 'SKIPPED/ALREADY_DONE' WHEN doc_id % 11 = 0 THEN 'SKIPPED/EMPTY_TEXT' WHEN greatest(1, length(text) // 4) > 800 THEN 'FAILED/INPUT_TOO_LONG' ELSE 'BATCH' END AS class FROM documents")
def row_classification(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    m = lambda n: F.pmod("doc_id", F.lit(n)) == 0
    source = docs.where(~m(7)).select("doc_id", F.when(m(11), " \n").otherwise(F.col("text")).alias("text"), F.when(m(5), F.array(F.lit(1.0))).alias("vector"))
    got = ledger.classify(docs.select("doc_id"), source, "doc_id", "text", "vector", text.estimate_tokens(F.col("text")), most_tokens=800)
    return got.select("doc_id", "class")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 OR doc_id % 4 = 0 THEN 'SOURCE_CHANGED' ELSE 'SUCCESS' END outcome FROM documents")
def vector_commit_guard(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    m = lambda n: F.pmod("doc_id", F.lit(n)) == 0
    vectors = docs.select("doc_id", F.md5("text").alias("digest"), F.array(F.lit(1.0)).alias("new_vector"))
    source = docs.select("doc_id", F.when(m(3), F.concat("text", F.lit("!"))).otherwise(F.col("text")).alias("text"), F.when(m(4), F.array(F.lit(0.5))).alias("vector"))
    return ledger.commit_vectors(source, vectors, "doc_id", "text", "vector").select("doc_id", "outcome")
