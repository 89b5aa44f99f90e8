"""Discovery of a table's ids as a stream whose offset is the last id: what a run has passed is
not read again, and what has come since is, also after a restart.

The driver reads the footers of a Parquet table only: the greatest id in their
statistics is the end of a batch, and each row group that reaches beyond its
start is a partition, so a task reads what it yields, in pages. Footers are kept
by file, as files of a table never change.

Ids must grow with time: a row that comes later with an id below the cursor is
not found (nor would a cursor in the table's own database find it).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as pads
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

PAGE = 2000


@dataclass
class Group(InputPartition):
    """A row group of a file, of which ids above ``after`` up to ``until`` are wanted."""

    file: str
    group: int
    after: object
    until: object

    def __post_init__(self):
        super().__init__(None)


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class NewIds(DataSource):
    """Options: path (of a Parquet table), key, vector (only rows where it is null), page, and most
    (only the first so many ids of the table, for trial runs)."""

    @classmethod
    def name(cls) -> str:
        return "new_ids"

    def schema(self) -> str:
        store, path = _store(self.options["path"])
        kind = pads.dataset(path, filesystem=store, format="parquet").schema.field(self.options["key"]).type
        names = {pa.int64(): "bigint", pa.int32(): "int", pa.string(): "string", pa.large_string(): "string"}
        return f"`{self.options['key']}` {names[kind]}"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return NewIdsReader(self.options)


class NewIdsReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.key, self.vector = options["path"], options["key"], options.get("vector")
        self.page, self.most = int(options.get("page", PAGE)), int(options.get("most", 0))
        self.known: dict[str, list[tuple[int, object, object, int]]] = {}

    def _groups(self) -> Iterator[tuple[str, int, object, object, int]]:
        """file, row group, least and greatest id, and rows, from footers."""
        store, path = _store(self.path)
        for fragment in pads.dataset(path, filesystem=store, format="parquet").get_fragments():
            if fragment.path not in self.known:
                fragment.ensure_complete_metadata()
                found = []
                for g in fragment.row_groups:
                    ends = (g.statistics or {}).get(self.key, {})
                    if g.num_rows and (ends or g.statistics is None or self.key not in g.statistics):
                        found.append((g.id, ends.get("min"), ends.get("max"), g.num_rows))
                self.known[fragment.path] = found
            for g in self.known[fragment.path]:
                yield fragment.path, *g

    def _ids(self, file: str, group: int) -> pa.Array:
        import pyarrow.parquet as pq

        store, _ = _store(self.path)
        with store.open_input_file(file) as source:
            return pq.ParquetFile(source).read_row_group(group, columns=[self.key])[self.key].combine_chunks().drop_null()

    def initialOffset(self) -> dict:
        return {"after": None}

    def latestOffset(self) -> dict:
        groups = [(file, g, lo, hi if hi is not None else pc.max(self._ids(file, g)).as_py()) for file, g, lo, hi, _ in self._groups()]
        groups = [g for g in groups if g[3] is not None]
        if not groups:
            return {"after": None}
        if not self.most:
            return {"after": max(g[3] for g in groups)}
        least = np.array([], object)  # at most ``most`` ids
        for file, g, lo, _ in sorted(groups, key=lambda x: (x[2] is not None, x[2])):
            if len(least) == self.most and lo is not None and lo > least[-1]:
                continue
            least = np.sort(np.concatenate([least, np.array(self._ids(file, g).to_pylist(), object)]))[: self.most]
        return {"after": least[-1] if len(least) else None}

    def partitions(self, start: dict, end: dict) -> list[Group]:
        after, until = start["after"], end["after"]
        if until is None or (after is not None and until <= after):
            return []
        return [Group(file, g, after, until) for file, g, lo, hi, _ in self._groups() if (after is None or hi is None or hi > after) and (lo is None or lo <= until)]

    def read(self, partition: Group) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        store, _ = _store(self.path)
        with store.open_input_file(partition.file) as source:
            t = pq.ParquetFile(source).read_row_group(partition.group, columns=[self.key, *([self.vector] if self.vector else [])])
        wanted = pc.and_(pc.is_valid(t[self.key]), pc.less_equal(t[self.key], partition.until))
        if partition.after is not None:
            wanted = pc.and_(wanted, pc.greater(t[self.key], partition.after))
        if self.vector:
            wanted = pc.and_(wanted, pc.is_null(t[self.vector]))
        ids = pc.sort_indices(t := t.filter(pc.fill_null(wanted, False)).select([self.key]), [(self.key, "ascending")])
        yield from t.take(ids).combine_chunks().to_batches(max_chunksize=self.page)

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


def new_ids(spark: SparkSession, path: str, key: str, vector: str | None = None, page: int = PAGE, most: int = 0) -> DataFrame:
    """The ids of a Parquet table as a stream, each once for all runs with one checkpoint."""
    spark.dataSource.register(NewIds)
    options = {"path": path, "key": key, "page": str(page), "most": str(most)} | ({"vector": vector} if vector else {})
    return spark.readStream.format("new_ids").options(**options).load()
