"""A store's listing in parallel: one task for each prefix, pages of rows as they come.

Prefixes are the folders of a given depth below the root, so the driver lists
few folders and no object; objects above that depth are a partition of their own.
A lister names a page of objects after another: the default one goes by
``pyarrow.fs`` (local, hdfs, s3); one for another service is a class with
``folders(root)`` and ``pages(prefix, recursive)``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "bucket string, key string, etag string, size bigint, last_modified timestamp"
_ARROW = pa.schema([("bucket", pa.string()), ("key", pa.string()), ("etag", pa.string()), ("size", pa.int64()), ("last_modified", pa.timestamp("us", "UTC"))])
PAGE = 1000


class StoreLister:
    """Objects of a pyarrow file system. A store that gives no ETag has none here: size and time stand for it, quoted as ETags are."""

    def __init__(self, root: str):
        from pyarrow import fs

        self.store, base = fs.FileSystem.from_uri(root)
        self.base = base.rstrip("/")

    def folders(self, path: str) -> list[str]:
        from pyarrow import fs

        found = self.store.get_file_info(fs.FileSelector(f"{self.base}/{path}".rstrip("/"), recursive=False))
        return sorted(f.path[len(self.base) + 1 :] for f in found if f.type == fs.FileType.Directory)

    def pages(self, prefix: str, recursive: bool) -> Iterator[list[dict]]:
        from pyarrow import fs

        bucket, held = self.base.rsplit("/", 1)[-1], []
        for f in self.store.get_file_info(fs.FileSelector(f"{self.base}/{prefix}".rstrip("/"), recursive=recursive)):
            if f.type == fs.FileType.File:
                held.append({"bucket": bucket, "key": f.path[len(self.base) + 1 :], "etag": f'"{f.size:x}-{f.mtime_ns or 0:x}"', "size": f.size, "last_modified": f.mtime})
            if len(held) == PAGE:
                yield held
                held = []
        if held:
            yield held


@dataclass
class Prefix(InputPartition):
    prefix: str
    recursive: bool

    def __post_init__(self):
        super().__init__(None)


class Listing(DataSource):
    """Options: root (of a bucket or folder) and depth (of the folders that are partitions)."""

    @classmethod
    def name(cls) -> str:
        return "store_listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ListingReader(self.options["root"], int(self.options.get("depth", 1)), StoreLister)


class ListingReader(DataSourceReader):
    def __init__(self, root: str, depth: int, lister):
        self.root, self.depth, self.lister = root, depth, lister

    def partitions(self) -> list[Prefix]:
        lister, level, out = self.lister(self.root), [""], []
        for _ in range(self.depth):
            out += [Prefix(p, False) for p in level]  # what lies in the folders themselves
            level = [f for p in level for f in lister.folders(p)]
        return out + [Prefix(p, True) for p in level]

    def read(self, partition: Prefix) -> Iterator[pa.RecordBatch]:
        for page in self.lister(self.root).pages(partition.prefix, partition.recursive):
            yield pa.RecordBatch.from_pylist(page, _ARROW)


def store_listing(spark: SparkSession, root: str, depth: int = 1) -> DataFrame:
    """bucket, key, etag, size and last_modified of all objects below a root; ``files.from_listing`` makes files of them."""
    spark.dataSource.register(Listing)
    return spark.read.format("store_listing").option("root", root).option("depth", str(depth)).load()
