"""A session with the settings that the engine's results rely on, reads that end in time, and results with an age."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


def session(name: str = "quillspark", master: str | None = None, **settings: str) -> SparkSession:
    """UTC, ANSI arithmetic and adaptive execution; more settings may be given or overridden."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
    }
    return builder.config(map=base | settings).getOrCreate()


def within(spark: SparkSession, seconds: float, action: Callable[[], object], tag: str = "read"):
    """The action's result; its jobs are cancelled, and TimeoutError is raised, if they take longer.

    The jobs bear a tag of their own, so no other job of the session is touched.
    """
    name, late = f"{tag}-{uuid.uuid4().hex}", threading.Event()

    def stop() -> None:
        late.set()
        while late.is_set():  # also jobs that start after the first call
            spark.sparkContext.cancelJobsWithTag(name)
            time.sleep(0.05)

    timer = threading.Timer(seconds, stop)
    timer.daemon = True
    spark.sparkContext.addJobTag(name)
    timer.start()
    try:
        return action()
    except Exception as e:
        if late.is_set():
            raise TimeoutError(f"not done in {seconds:g} seconds") from e
        raise
    finally:
        timer.cancel()
        late.clear()
        spark.sparkContext.removeJobTag(name)


class Aged:
    """Small results by key that are read again once they are older than ``seconds``; if that fails, the old one stays with its age."""

    def __init__(self, seconds: float, clock: Callable[[], float] = time.monotonic):
        self.seconds, self.clock, self.held = seconds, clock, {}

    def get(self, key, read: Callable[[], object]) -> tuple[object, float]:
        """The result and its age in seconds."""
        now = self.clock()
        if key in self.held and now - self.held[key][1] < self.seconds:
            return self.held[key][0], now - self.held[key][1]
        try:
            self.held[key] = read(), self.clock()
        except Exception:
            if key not in self.held:
                raise
        return self.held[key][0], self.clock() - self.held[key][1]
