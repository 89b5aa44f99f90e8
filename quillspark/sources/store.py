"""Tables and folders that driver and executors share, for steps that must not run twice."""

from __future__ import annotations

import random
import tempfile
import time
import uuid
from collections.abc import Callable
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; only a local master may go without that setting."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='shared-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table as it is written once: later steps read it, and a lost executor costs a reread."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_files(contents: DataFrame, name: str) -> DataFrame:
    """doc_id and path of a file for each row of doc_id and content, in the shared folder. A file has its name once it is complete."""
    folder = shared_folder(contents.sparkSession, name)

    def run(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base)
        for batch in batches:
            paths = []
            for doc_id, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                named = sha256(doc_id.encode()).hexdigest()  # an id may hold anything
                own = f"{base}/.{named}-{uuid.uuid4().hex}"
                with store.open_output_stream(own) as sink:
                    sink.write(content or b"")
                try:
                    store.move(own, f"{base}/{named}")
                except OSError:  # a task that ran before has left the same file, and the store does not replace it
                    store.delete_file(own)
                paths.append(f"{folder}/{named}")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.string())], names=["doc_id", "path"])

    return stored(contents.select("doc_id", "content").mapInArrow(run, "doc_id string, path string"), name)


def written_below(contents: DataFrame, name: str) -> str:
    """The folder of shared storage where each row of key and content is a file at its key."""
    root = shared_folder(contents.sparkSession, name)

    def run(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for key, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store.create_dir(f"{base}/{key}".rsplit("/", 1)[0])
                with store.open_output_stream(f"{base}/{key}") as sink:
                    sink.write(content or b"")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    contents.select("key", "content").mapInArrow(run, "n long").write.format("noop").mode("overwrite").save()
    return root


def retrying(action: Callable[[], object], transient: tuple[type[Exception], ...] = (OSError,), attempts: int = 6, wait: Callable[[float], None] = time.sleep):
    """The action's result; failures that pass by themselves are tried again, only the action and nothing before it."""
    for n in range(attempts):
        try:
            return action()
        except transient:
            if n + 1 == attempts:
                raise
            wait(0.1 * 2**n * (1 + random.random()))
