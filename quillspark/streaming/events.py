"""Event-time windows over a stream of events, with late data bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_events(spark: SparkSession, folder: str, like: DataFrame, files: int = 16) -> DataFrame:
    """A file stream of a Parquet table (a folder, or one file), with ts as an instant."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    single = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path).isFile()
    source, names = (folder.rsplit("/", 1)) if single else (folder, "*.parquet")
    stream = spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files).option("pathGlobFilter", names).parquet(source)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, late: str = "1 hour", width: str = "1 day", slide: str | None = None) -> DataFrame:
    """Counts and sums by window and type; with a slide the windows overlap."""
    window = F.window("ts", width, slide) if slide else F.window("ts", width)
    rows = events.withWatermark("ts", late).groupBy(window.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return rows.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def sessions(events: DataFrame, late: str = "1 hour", gap: str = "30 minutes") -> DataFrame:
    """Runs of a user's events without a longer gap."""
    rows = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return rows.select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def run_whole(df: DataFrame, path: str, checkpoint: str) -> None:
    """Process all that is there now; each micro-batch writes the whole result anew, so a batch that
    runs again changes nothing. Nothing passes the driver."""
    write = lambda batch, n: batch.write.mode("overwrite").parquet(path)
    df.writeStream.foreachBatch(write).outputMode("complete").option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def run_to_parquet(df: DataFrame, path: str, checkpoint: str) -> None:
    """Append finished rows to a Parquet table, exactly once, until all that is there now is processed."""
    df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()


def failures_of(tasks: DataFrame, failures: DataFrame, within: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Failures that follow an event of the same user in time, as a join of two streams: both have
    user_id, ts and event_id, and state is kept only as long as a partner may still come."""
    a = tasks.select("user_id", F.col("event_id").alias("task_id"), F.col("ts").alias("task_ts")).withWatermark("task_ts", late)
    b = failures.select(F.col("user_id").alias("_user"), F.col("event_id").alias("failure_id"), F.col("ts").alias("failure_ts")).withWatermark("failure_ts", late)
    near = F.expr(f"user_id = _user AND failure_ts >= task_ts AND failure_ts <= task_ts + INTERVAL {within}")
    return a.join(b, near).select("user_id", "task_id", "failure_id")


def once(events: DataFrame, key: str = "event_id", late: str = "1 hour") -> DataFrame:
    """The first of events that are sent again within the watermark's delay."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def run_counted(df: DataFrame, path: str, checkpoint: str) -> int:
    """run_to_parquet, and how many rows (of partial sums, for a grouping) came too late for the watermark."""
    q = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return sum(s.numRowsDroppedByWatermark for p in q.recentProgress for s in p.stateOperators)
