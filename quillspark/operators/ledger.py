"""The ingestion log and the task ledger as tables: every change is a join that
gives the table's next state, with time and tokens as arguments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.status import ingests, row_class, should_ingest, times_match


def decide(files: DataFrame, log: DataFrame, most_retries: int = 2, force: bool = False, match_times: bool = True) -> DataFrame:
    """Files with the reason for which they are taken or left (crawl ladder and log ladder).

    ``files`` has doc_id, file_hash, file_size, last_modified and readable;
    ``match_times`` skips a finished file by its time alone, before its hash.
    """
    old = log.select("doc_id", F.col("status").alias("l_status"), F.col("retry_count").alias("l_retries"), F.col("file_hash").alias("l_hash"), F.col("last_modified").alias("l_modified"), F.lit(True).alias("l_known"))
    rows = files.join(old, "doc_id", "left")
    known = F.coalesce("l_known", F.lit(False))
    ladder = should_ingest(known, F.col("l_status"), F.col("l_retries"), F.col("l_hash"), F.col("file_hash"), most_retries)
    quick = (F.col("l_status") == "SUCCESS") & times_match(F.col("last_modified"), F.col("l_modified")) if match_times else F.lit(False)
    reason = F.when(~F.coalesce("readable", F.lit(True)), "not_readable").when(F.col("file_size") <= 0, "empty_file")
    reason = reason.otherwise("new_file") if force else reason.when(F.coalesce(known & quick, F.lit(False)), "unchanged").otherwise(ladder)
    return rows.select(files["*"], reason.alias("reason")).withColumn("should_process", ingests(F.col("reason")))


def crawl_stats(decided: DataFrame) -> DataFrame:
    """Counts, bytes to read and bytes avoided, and files by extension, in one row."""
    take = F.col("should_process")
    extension = F.lower(F.regexp_extract("file_path", r"(\.[^./\\]+)$", 1))
    by = decided.groupBy(extension.alias("ext")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(take).alias("t"), F.count_if(F.col("reason") == "unchanged").alias("u"), F.count_if(F.col("reason") == "not_readable").alias("e"),
        F.sum(F.when(take, F.col("file_size")).otherwise(0)).alias("b"), F.sum(F.when(~take, F.col("file_size")).otherwise(0)).alias("a"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return by.agg(total("n").alias("found"), total("t").alias("to_process"), total("u").alias("unchanged"), total("e").alias("errors"), total("b").alias("bytes_to_read"), total("a").alias("bytes_avoided"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("ext", "n")))).alias("by_extension"))


def upsert_log(log: DataFrame, changes: DataFrame, now: Column) -> DataFrame:
    """The log after changes by doc_id: ingested_at stays, retry_count grows where asked (not on a first insert)."""
    old, new = log.alias("o"), changes.alias("n")
    has_old, has_new = F.col("o.doc_id").isNotNull(), F.col("n.doc_id").isNotNull()
    keep = lambda c: F.when(has_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)
    retries = F.when(has_old, F.col("o.retry_count") + F.when(has_new & F.col("n.increment_retry"), 1).otherwise(0)).otherwise(0)
    columns = [c for c in changes.columns if c in log.columns and c not in ("doc_id", "retry_count", "ingested_at", "updated_at")]
    same = [c for c in log.columns if c not in (*columns, "doc_id", "retry_count", "ingested_at", "updated_at")]
    return old.join(new, F.col("o.doc_id") == F.col("n.doc_id"), "full").select(
        F.coalesce("o.doc_id", "n.doc_id").alias("doc_id"), *map(keep, columns), *(F.col(f"o.{c}").alias(c) for c in same),
        retries.cast("int").alias("retry_count"), F.when(has_old, F.col("o.ingested_at")).otherwise(now).alias("ingested_at"), F.when(has_new, now).otherwise(F.col("o.updated_at")).alias("updated_at"),
    )


def stale_reset(log: DataFrame, as_of: Column, minutes: int = 60) -> DataFrame:
    """RUNNING rows without a change for so long are PENDING again; ``was_stale`` marks them."""
    stale = (F.col("status") == "RUNNING") & (F.col("updated_at") < as_of - F.make_dt_interval(mins=F.lit(minutes)))
    rows = log.withColumn("was_stale", F.coalesce(stale, F.lit(False)))
    return rows.withColumn("status", F.when(F.col("was_stale"), "PENDING").otherwise(F.col("status")))


def enqueue(tasks: DataFrame, found: DataFrame, requeue: bool = True) -> DataFrame:
    """Tasks after discovery of (job_key, row_id): new ones are PENDING, finished ones
    return to PENDING, failed and running ones stay."""
    key = ["job_key", "row_id"]
    joined = tasks.join(found.select(*key).distinct().withColumn("found", F.lit(True)), key, "full")
    again = F.col("found") & (F.col("status").isin("SUCCESS", "SKIPPED") if requeue else F.lit(False))
    return joined.select(*key, F.when(F.col("status").isNull() | F.coalesce(again, F.lit(False)), "PENDING").otherwise(F.col("status")).alias("status"))


def insert_ignore(table: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    """The table with rows whose key it lacks."""
    return table.unionByName(rows.dropDuplicates(key).join(table.select(*key), key, "left_anti"))


def claimable(tasks: DataFrame, as_of: Column, limit: int) -> DataFrame:
    """The first tasks by id that are PENDING, or RUNNING with a lease that has ended: a batch."""
    return tasks.where((F.col("status") == "PENDING") | ((F.col("status") == "RUNNING") & (F.col("lease_until") < as_of))).orderBy("row_id").limit(limit)


def claim(tasks: DataFrame, owner: str, token: str, as_of: Column, lease_seconds: int, limit: int) -> DataFrame:
    """All tasks after one batch is claimed."""
    batch = claimable(tasks, as_of, limit).select("job_key", "row_id", F.lit(True).alias("mine"))
    mine = F.coalesce("mine", F.lit(False))
    pick = lambda c, new: F.when(mine, new).otherwise(F.col(c)).alias(c)
    changed = {"status": F.lit("RUNNING"), "owner": F.lit(owner), "claim_token": F.lit(token), "lease_until": as_of + F.make_dt_interval(secs=F.lit(lease_seconds)), "attempts": F.col("attempts") + 1}
    rows = tasks.join(batch, ["job_key", "row_id"], "left")
    return rows.select(*(pick(c, changed[c]) if c in changed else F.col(c) for c in tasks.columns))


def renew(tasks: DataFrame, owner: str, as_of: Column, lease_seconds: int, locked: DataFrame | None = None) -> DataFrame:
    """Leases of the owner's running tasks from now on; rows in ``locked`` are passed over."""
    rows = tasks if locked is None else tasks.join(locked.select("job_key", "row_id", F.lit(True).alias("held")).distinct(), ["job_key", "row_id"], "left")
    free = F.lit(True) if locked is None else F.col("held").isNull()
    own = (F.col("status") == "RUNNING") & (F.col("owner") == owner) & free
    lease = F.when(own, as_of + F.make_dt_interval(secs=F.lit(lease_seconds))).otherwise(F.col("lease_until"))
    return rows.withColumn("lease_until", lease).select(tasks.columns)


def finish(tasks: DataFrame, results: DataFrame, now: Column, note_limit: int = 400) -> tuple[DataFrame, DataFrame]:
    """Tasks after results (job_key, row_id, claim_token, status, code, message), and the failure events.

    A result counts only if its token is the task's: a worker that lost its
    lease changes nothing.
    """
    r = results.select("job_key", "row_id", F.col("claim_token").alias("r_token"), F.col("status").alias("r_status"), F.col("code").alias("r_code"), F.col("message").alias("r_message"))
    rows = tasks.join(r, ["job_key", "row_id"], "left")
    holds = F.coalesce((F.col("status") == "RUNNING") & (F.col("claim_token") == F.col("r_token")), F.lit(False))
    change = {"status": F.col("r_status"), "error_code": F.col("r_code"), "error_message": F.left("r_message", F.lit(2000)), "owner": F.lit(None).cast("string"), "claim_token": F.lit(None).cast("string"), "lease_until": F.lit(None).cast("timestamp"), "updated_at": now}
    after = rows.select(*(F.when(holds, change[c]).otherwise(F.col(c)).alias(c) if c in change else F.col(c) for c in tasks.columns))
    failed = rows.where(holds & (F.col("r_status") == "FAILED"))
    events = failed.select("job_key", "row_id", F.col("r_code").alias("error_code"), F.left("r_message", F.lit(2000)).alias("error_message"), F.left(F.concat_ws(": ", "r_code", "r_message"), F.lit(note_limit)).alias("note"), now.alias("occurred_at"))
    return after, events


def requeue_failed(tasks: DataFrame) -> DataFrame:
    return tasks.withColumn("status", F.when(F.col("status") == "FAILED", "PENDING").otherwise(F.col("status")))


def release(tasks: DataFrame, owner: str) -> DataFrame:
    own = (F.col("status") == "RUNNING") & (F.col("owner") == owner)
    return tasks.withColumn("status", F.when(own, "PENDING").otherwise(F.col("status")))


def is_complete(tasks: DataFrame, discovery_done: bool) -> bool:
    """Whether nothing is left: an existence test, not a count."""
    return discovery_done and tasks.where(F.col("status").isin("PENDING", "RUNNING")).isEmpty()


def classify(ids: DataFrame, source: DataFrame, key: str, text: str, vector: str, tokens: Column, **limits) -> DataFrame:
    """Every wanted id with what becomes of it: absent ids are found by the left join."""
    rows = ids.join(source.select(key, text, vector, F.lit(True).alias("present")), key, "left")
    return rows.withColumn("class", row_class(F.coalesce("present", F.lit(False)), F.col(vector), F.col(text), tokens, **limits))


def commit_vectors(source: DataFrame, vectors: DataFrame, key: str, text: str, vector: str, reuse: bool = True) -> DataFrame:
    """Vectors (key, digest, new_vector) by outcome: SUCCESS where the text is still the one
    that was embedded (its MD5 fits) and, with reuse, none is there yet; else SOURCE_CHANGED."""
    fits = (F.md5(F.col(text)) == F.col("digest")) & (F.col(vector).isNull() if reuse else F.lit(True))
    rows = vectors.join(source.select(key, text, vector), key, "left")
    return rows.select(key, "new_vector", F.when(F.coalesce(fits, F.lit(False)), "SUCCESS").otherwise("SOURCE_CHANGED").alias("outcome"))


def not_current(docs: DataFrame, results: DataFrame) -> DataFrame:
    """Documents without a result for their source hash and profile."""
    return docs.join(results, ["doc_id", "source_hash", "profile_hash"], "left_anti")


def unlocked(docs: DataFrame, locks: DataFrame, owner: str, as_of: Column) -> DataFrame:
    """Documents that nobody else holds: locks have doc_id, owner and until."""
    held = locks.where((F.col("until") > as_of) & (F.col("owner") != owner))
    return docs.join(held.select("doc_id"), "doc_id", "left_anti")


def take_locks(locks: DataFrame, docs: DataFrame, owner: str, as_of: Column, seconds: int) -> DataFrame:
    """Locks (doc_id, owner, until) after an owner has asked for documents: it gets those that nobody else
    holds, and prolongs its own. Locks that are over stay until they are taken or released."""
    wanted = docs.select("doc_id", F.lit(True).alias("_wanted")).distinct()
    rows = locks.join(wanted, "doc_id", "full")
    gets = F.col("_wanted") & (F.col("owner").isNull() | (F.col("owner") == owner) | (F.col("until") <= as_of))
    gets = F.coalesce(gets, F.lit(False))
    return rows.select("doc_id", F.when(gets, F.lit(owner)).otherwise(F.col("owner")).alias("owner"), F.when(gets, as_of + F.make_dt_interval(secs=F.lit(seconds))).otherwise(F.col("until")).alias("until"))


def release_locks(locks: DataFrame, owner: str, docs: DataFrame | None = None) -> DataFrame:
    """Locks without the owner's: all of them, or those of some documents."""
    own = locks.where(F.col("owner") == owner)
    gone = own.select("doc_id") if docs is None else own.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id")
    return locks.join(gone, "doc_id", "left_anti")


def register_run(runs: DataFrame, job: str, deployment: str, rpm: float, tpm: float, now: Column, profile: str | None = None, source: str | None = None) -> DataFrame:
    """Runs (job_key, deployment_key, rpm, tpm, profile_name, source_table, started_at) after a run is registered.

    A job that is there already goes on: it keeps what is not given anew. Other
    jobs of one deployment must have the same limits, as they draw from one quota.
    """
    other = runs.where((F.col("deployment_key") == deployment) & (F.col("job_key") != job) & ((F.col("rpm") != rpm) | (F.col("tpm") != tpm))).first()
    if other is not None:
        raise ValueError(f"deployment {deployment} has other limits in job {other['job_key']}: {other['rpm']:g} requests and {other['tpm']:g} tokens a minute")
    one = runs.sparkSession.range(1).select(F.lit(job).alias("job_key"), F.lit(deployment).alias("d"), F.lit(float(rpm)).alias("r"), F.lit(float(tpm)).alias("t"), F.lit(profile).cast("string").alias("p"), F.lit(source).cast("string").alias("s"), now.alias("n"))
    rows = runs.join(one, "job_key", "full")
    new = {"deployment_key": "d", "rpm": "r", "tpm": "t", "profile_name": "p", "source_table": "s", "started_at": "n"}
    return rows.select("job_key", *(F.coalesce(n, c).alias(c) for c, n in new.items()))


def failed_documents(log: DataFrame) -> DataFrame:
    return log.where(F.col("status") == "ERROR").orderBy(F.desc("updated_at"), "doc_id")


def retry_queue(log: DataFrame, files: DataFrame) -> DataFrame:
    """Failed documents that can still be reached, with the hash that they have now."""
    return failed_documents(log).drop("file_hash").join(files.where("readable").select("doc_id", "file_hash"), "doc_id")
