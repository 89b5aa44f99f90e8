"""Embedding what arrives: a file stream whose checkpoint is the discovery cursor."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.batching import embed


def embed_stream(rows: DataFrame, key: str, text: str, provider: Callable[[list[str]], list], dimensions: int) -> DataFrame:
    """Results for new rows; blank texts are skipped. Stateless, so it scales with the stream's tasks."""
    return embed(rows.where(F.trim(F.coalesce(F.col(text), F.lit(""))) != ""), key, text, provider, dimensions)


def run_available(results: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process all that is there now; a batch that failed runs again with the same id."""
    results.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
