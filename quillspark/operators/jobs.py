"""Status of jobs, their tasks, claims and failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.status import job_phase

STATUSES = ("PENDING", "RUNNING", "SUCCESS", "FAILED", "SKIPPED")
JOBS, FAILURES = 30, 200


def pipeline_stats(log: DataFrame) -> DataFrame:
    return log.groupBy("status").agg(F.count(F.lit(1)).alias("docs"), F.sum("chunk_count").alias("chunks"), F.sum("pages_total").alias("pages")).orderBy("status")


def status_health(log: DataFrame) -> DataFrame:
    return log.groupBy("status").agg(F.count(F.lit(1)).alias("docs"), F.round(F.avg("pages_total"), 1).alias("avg_pages"), F.max("ingested_at").alias("last_ingest"))


def task_counts(tasks: DataFrame) -> DataFrame:
    return tasks.groupBy("job_key", "status").agg(F.count(F.lit(1)).alias("n"))


def status_pivot(tasks: DataFrame) -> DataFrame:
    """A row for each job with a count of each status, in one aggregation."""
    return tasks.groupBy("job_key").agg(*(F.count_if(F.col("status") == s).alias(s.lower()) for s in STATUSES))


def active(tasks: DataFrame, as_of: Column) -> DataFrame:
    return tasks.where((F.col("status") == "RUNNING") & (F.col("lease_until") > as_of))


def claims_by_owner(tasks: DataFrame, as_of: Column) -> DataFrame:
    """Active claims of each job and owner, and of each job (owner null): grouping sets in one pass."""
    rows = active(tasks, as_of)
    both = rows.groupingSets([["job_key", "owner"], ["job_key"]], "job_key", "owner")
    return both.agg(F.count(F.lit(1)).alias("claims"), F.max("lease_until").alias("last_lease"), F.grouping("owner").cast("int").alias("is_total"))


def summaries(jobs: DataFrame, tasks: DataFrame, as_of: Column) -> DataFrame:
    """Phase and progress of each job: left joins of jobs with counts and claims."""
    claims = active(tasks, as_of).groupBy("job_key").agg(F.count(F.lit(1)).alias("active"))
    rows = jobs.join(status_pivot(tasks), "job_key", "left").join(claims, "job_key", "left")
    n = {s.lower(): F.coalesce(F.col(s.lower()), F.lit(0)) for s in STATUSES}
    claimed = F.coalesce("active", F.lit(0))
    total = sum(n.values(), F.lit(0))
    done = n["success"] + n["failed"] + n["skipped"]
    return rows.select(
        "job_key",
        *(c.alias(s) for s, c in n.items()),
        claimed.alias("active"),
        job_phase(F.col("discovery_done"), n["pending"], n["running"], n["success"], n["failed"], n["skipped"], claimed).alias("phase"),
        F.when(total > 0, done / total).otherwise(F.lit(0.0)).alias("progress"),
    )


def latest_jobs(jobs: DataFrame, limit: int) -> DataFrame:
    return jobs.orderBy(F.desc("created_at"), "job_key").limit(min(max(limit, 1), JOBS))


def label(profile: Column, schema: Column, table: Column, key: Column, most: Column) -> Column:
    """What a job is shown as: its profile, source, key and limit."""
    source = F.coalesce(F.nullif(F.concat_ws(".", F.nullif(schema, F.lit("")), F.nullif(table, F.lit(""))), F.lit("")), F.lit("Older job · target unlabeled"))
    limit = F.when(most > 0, F.concat(F.lit("pilot ≤"), F.format_number(most, 0)))
    return F.concat_ws(" · ", F.nullif(profile, F.lit("")), source, F.left(key, F.lit(12)), limit)


def dashboard_order(summary: DataFrame) -> DataFrame:
    """Jobs with active claims first, then the newest."""
    return summary.orderBy((F.col("active") > 0).desc(), F.desc("created_at"), "job_key")


def failure_reasons(failed: DataFrame) -> DataFrame:
    return failed.groupBy(F.coalesce("error_code", F.lit("UNKNOWN")).alias("reason")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reason")


def recent_failures(failed: DataFrame, limit: int, order: str = "updated_at") -> DataFrame:
    rows = failed.withColumns({"error_message": F.left("error_message", F.lit(400)), "processing_comment": F.left("processing_comment", F.lit(200))})
    return rows.orderBy(F.desc(order), "row_id").limit(min(max(limit, 1), FAILURES))


def runs_with_tasks(runs: DataFrame, tasks: DataFrame) -> DataFrame:
    """Every run with its counts, also runs without a task."""
    counts = tasks.groupBy("job_key").agg(F.count(F.lit(1)).alias("tasks"), *(F.count_if(F.col("status") == s).alias(s.lower()) for s in STATUSES))
    names = ["tasks", *(s.lower() for s in STATUSES)]
    return runs.join(counts, "job_key", "left").select("job_key", *(F.coalesce(n, F.lit(0)).alias(n) for n in names))


def run_summary(rows: DataFrame, status: str) -> DataFrame:
    """Counts by status with their share."""
    n = F.count(F.lit(1))
    return rows.groupBy(status).agg(n.alias("n")).withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 1))


def rates(samples: DataFrame, key: str, time: str, done: str) -> DataFrame:
    """Rows a minute between a sample and the one before it; null for the first."""
    w = Window.partitionBy(key).orderBy(time, done)
    seconds = (F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(F.lag(time).over(w).cast("timestamp"))) / 1e6
    change = F.col(done) - F.lag(done).over(w)
    return samples.withColumn("per_minute", F.greatest(F.lit(0.0), F.try_divide(change * F.lit(60.0), seconds)))


def eta(samples: DataFrame, total: Column, done: Column, elapsed: Column) -> DataFrame:
    """Throughput, and the seconds left at it."""
    rate = F.try_divide(done, elapsed)
    return samples.withColumns({"per_second": rate, "seconds_left": F.try_divide(total - done, rate)})
