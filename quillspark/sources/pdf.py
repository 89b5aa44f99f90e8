"""PDF files as rows of elements, through any parser.

A parser is a callable that executors can load: bytes -> (contents, elements),
with contents as (level, title, page) and elements as dicts of page, kind
(text, image or table), x0, y0, x1, y1, text, cells (rows of a table's cells)
and image (bytes). No parser is built in. A file that cannot be read
gives one row with the error, and never ends the job.

A parser may have ``open`` instead, which takes a file that can seek and gives
a document with ``pages`` (their number), ``contents()`` and ``elements(page)``
(pages count from 1). Its pages are read one by one: a page that fails gives
a row with its number and the error, and the others stay. Files that are named by
their paths are dealt to tasks by ranges of pages (``parse_ranges``), so a file
of thousands of pages is many tasks, and none holds more than a range's elements.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored

SCHEMA = "doc_id string, page int, ordinal int, kind string, x0 double, y0 double, x1 double, y1 double, text string, cells array<array<string>>, image binary, error string"
_ARROW = pa.schema([("doc_id", pa.string()), ("page", pa.int32()), ("ordinal", pa.int32()), ("kind", pa.string()), *((k, pa.float64()) for k in ("x0", "y0", "x1", "y1")), ("text", pa.string()), ("cells", pa.list_(pa.list_(pa.string()))), ("image", pa.binary()), ("error", pa.string())])


#: Pages of a range, and ranges of a task beyond the session's number of partitions.
RANGE, TASK_RANGES = 64, 8
MESSAGE = 2000


def _toc(doc_id: str, contents: list) -> list[dict]:
    return [{"doc_id": doc_id, "page": page, "ordinal": i, "kind": "toc", "x0": float(level), "text": title} for i, (level, title, page) in enumerate(contents) if page > 0]


def _pages(doc_id: str, document, first: int, last: int) -> Iterator[dict]:
    """Rows of some pages; of a document's first one also its contents."""
    if first <= 1:
        yield from _toc(doc_id, document.contents())
    for page in range(max(1, first), last + 1):
        try:
            elements = [{"doc_id": doc_id, "page": page, "ordinal": i} | e for i, e in enumerate(document.elements(page))]
        except Exception as e:  # noqa: BLE001  a bad page is a row, not a failure
            elements = [{"doc_id": doc_id, "page": page, "error": str(e)[:MESSAGE] or type(e).__name__}]
        yield from elements


def _batches(rows: Iterator[dict], most: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pa.RecordBatch.from_pylist(held, _ARROW)
            held = []
    yield pa.RecordBatch.from_pylist(held, _ARROW)


def parse(files: DataFrame, parser: Callable[[bytes], tuple[list, list[dict]]]) -> DataFrame:
    """Element rows of files (doc_id, content); entries of the contents have kind ``toc`` and their level in x0."""

    def rows(doc_id: str, content: bytes) -> Iterator[dict]:
        try:
            if hasattr(parser, "open"):
                document = parser.open(io.BytesIO(content))
                yield from _pages(doc_id, document, 1, document.pages)
                return
            contents, elements = parser(content)
        except Exception as e:  # noqa: BLE001  a bad file is a row, not a failure
            yield {"doc_id": doc_id, "error": str(e)[:MESSAGE]}
            return
        yield from _toc(doc_id, contents)
        for i, e in enumerate(elements):
            yield {"doc_id": doc_id, "ordinal": i} | e

    def run(batches):
        for batch in batches:
            for doc_id, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield from _batches(rows(doc_id, content))

    return files.select("doc_id", "content").mapInArrow(run, SCHEMA)


def _opened(parser, path: str):
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return parser.open(store.open_input_file(name))


def page_counts(files: DataFrame, parser) -> DataFrame:
    """doc_id, path, pages and error of files (doc_id, path): only what tells the number of pages is read."""

    def run(batches):
        for batch in batches:
            out = []
            for doc_id, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    out.append({"doc_id": doc_id, "path": path, "pages": _opened(parser, path).pages})
                except Exception as e:  # noqa: BLE001
                    out.append({"doc_id": doc_id, "path": path, "error": str(e)[:MESSAGE] or type(e).__name__})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("doc_id", pa.string()), ("path", pa.string()), ("pages", pa.int32()), ("error", pa.string())]))

    return files.select("doc_id", "path").mapInArrow(run, "doc_id string, path string, pages int, error string")


def parse_ranges(files: DataFrame, parser, pages: int = RANGE, tasks: int | None = None) -> DataFrame:
    """The same rows of files (doc_id, path), with each range of pages read on its own.

    Numbers of pages are stored first; then there is a task for each few ranges.
    """
    counted = stored(page_counts(files, parser), "page-counts")
    ranges = counted.where("pages > 0").select("doc_id", "path", F.explode(F.sequence(F.lit(1), "pages", F.lit(pages))).alias("first"), "pages").withColumn("last", F.least(F.col("first") + pages - 1, "pages"))

    def run(batches):
        for batch in batches:
            for doc_id, path, first, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                def rows() -> Iterator[dict]:
                    try:
                        document = _opened(parser, path)  # noqa: B023
                    except Exception as e:  # noqa: BLE001
                        yield {"doc_id": doc_id, "error": str(e)[:MESSAGE] or type(e).__name__}  # noqa: B023
                        return
                    yield from _pages(doc_id, document, first, last)  # noqa: B023

                yield from _batches(rows())

    n = counted.agg(F.sum(F.ceil(F.col("pages") / pages))).first()[0] or 0
    tasks = tasks or max(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // TASK_RANGES))
    parsed = ranges.select("doc_id", "path", "first", "last").repartition(tasks, "doc_id", "first").mapInArrow(run, SCHEMA)
    failed = counted.where("error is not null")
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) if f.name not in ("doc_id", "error") else F.col(f.name) for f in parsed.schema.fields]
    return parsed.unionAll(failed.select(nothing))


class TextPages:
    """A plain format: pages are parted by form feeds, a line is an element, ``#`` starts an entry of the contents.

    A page with a NUL cannot be read.
    """

    def open(self, file) -> TextPages:
        out = TextPages()
        out.texts = file.read().decode().split("\f")
        out.pages = len(out.texts)
        return out

    def contents(self) -> list[tuple[int, str, int]]:
        return [(1, line[1:].strip(), at + 1) for at, text in enumerate(self.texts) for line in text.split("\n") if line.startswith("#")]

    def elements(self, page: int) -> list[dict]:
        text = self.texts[page - 1]
        if "\0" in text:
            raise ValueError(f"page {page} cannot be read")
        lines = [(i, line) for i, line in enumerate(text.split("\n")) if line.strip()]
        return [{"kind": "text", "x0": 0.0, "y0": 12.0 * i, "x1": 6.0 * len(line), "y1": 12.0 * i + 10, "text": line} for i, line in lines]
