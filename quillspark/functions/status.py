"""Decisions on states of documents, jobs and files. All are CASE ladders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def document_stage(total: Column, embedded: Column) -> Column:
    return F.when(total <= 0, "Unknown").when(embedded >= total, "Complete").when(embedded > 0, "Partial").otherwise("Not started")


def coverage(embedded: Column, total: Column) -> Column:
    """Share that is embedded; 0 of nothing."""
    return F.when(total > 0, embedded / total).otherwise(F.lit(0.0))


def job_phase(discovery_done: Column, pending: Column, running: Column, success: Column, failed: Column, skipped: Column, active: Column) -> Column:
    total = pending + running + success + failed + skipped
    return (
        F.when(active > 0, "Active claims")
        .when(~discovery_done, "Discovering / awaiting worker")
        .when(pending + running > 0, "Pending / no active lease")
        .when(failed > 0, "Completed with failures")
        .when(total > 0, "Completed")
        .otherwise("No tasks discovered")
    )


def should_ingest(known: Column, status: Column, retries: Column, old_hash: Column, new_hash: Column, most_retries: int = 2) -> Column:
    """Why a file is ingested or not. Retries are tested before the hash, on purpose:
    a changed file that has failed too often stays out."""
    return (
        F.when(~known, "new_file")
        .when((status == "ERROR") & (retries >= most_retries), F.format_string("max_retries_exceeded (%d)", retries))
        .when(status == "RUNNING", "already_running")
        .when((status == "SUCCESS") & old_hash.eqNullSafe(new_hash), "unchanged")
        .when(~old_hash.eqNullSafe(new_hash), "file_modified")
        .when(status.isin("PENDING", "ERROR"), F.concat(F.lit("retry (status="), status, F.lit(")")))
        .otherwise("skip")
    )


def ingests(reason: Column) -> Column:
    return reason.isin("new_file", "file_modified") | reason.startswith("retry")


def times_match(a: Column, b: Column, tolerance_us: int = 2_000_000) -> Column:
    """Within the tolerance; never if one is missing."""
    return F.coalesce(F.abs(F.unix_micros(a.cast("timestamp")) - F.unix_micros(b.cast("timestamp"))) <= tolerance_us, F.lit(False))


def row_class(present: Column, vector: Column, text: Column, tokens: Column, reuse: bool = True, most_tokens: int = 8191, batch_tokens: int = 24_000) -> Column:
    """What becomes of a row of a backfill: STATUS/CODE, or BATCH."""
    blank = text.isNull() | (F.trim(F.regexp_replace(text, r"(?U)\s+", " ")) == "")
    done = vector.isNotNull() if reuse else F.lit(False)
    return (
        F.when(~present, "SKIPPED/MISSING")
        .when(done, "SKIPPED/ALREADY_DONE")
        .when(blank, "SKIPPED/EMPTY_TEXT")
        .when((tokens > most_tokens) | (tokens > batch_tokens), "FAILED/INPUT_TOO_LONG")
        .otherwise("BATCH")
    )


def duration(seconds: Column) -> Column:
    """12s, 3m or 2h05m."""
    hours, minutes = F.floor(seconds / 3600).cast("long"), F.floor(seconds % 3600 / 60).cast("long")
    return F.when(seconds < 60, F.format_string("%.0fs", seconds.cast("double"))).when(seconds < 3600, F.format_string("%.0fm", seconds.cast("double") / 60)).otherwise(F.format_string("%dh%02dm", hours, minutes))
