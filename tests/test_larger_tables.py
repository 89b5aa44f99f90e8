"""What only shows on longer texts and larger tables."""

import random
from types import SimpleNamespace

import duckdb
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from quillspark.functions import text, vectors
from quillspark.operators import chunking, providers, tables
from quillspark.operators.quota import Bucket
from quillspark.plans import pipelines
from quillspark.plans.standins import as_of
from quillspark.session import within
from quillspark.streaming import in_order, quota, shared_quota

PAGES = "doc_id string, page int, is_blank boolean, error string, text string, content_types array<string>, heading string"
CONTENTS = "doc_id string, position int, title string, page int"
LIMITS = chunking.Limits(target=100, overlap=10, most=300, least=10, section_least=20, pages=2, contents_least=1)


def test_a_long_file_is_ingested(spark):
    texts = {"a": "A sentence of a long text. " * 60, "b": "A short text of one page."}
    found = spark.createDataFrame([(k, f"{k}.txt", f"/in/{k}", k, len(t), True) for k, t in texts.items()], "doc_id string, file_name string, file_path string, file_hash string, file_size long, readable boolean").withColumn("last_modified", as_of())
    log = found.limit(0).drop("readable").selectExpr("doc_id", "file_path", "file_name", "file_hash", "file_size", "last_modified", "'' status", "'' error_message", "0 retry_count", "0 chunk_count", "0 pages_total", "last_modified ingested_at", "last_modified updated_at")
    contents = spark.createDataFrame([(k, t.encode()) for k, t in texts.items()], "doc_id string, content binary")
    got = pipelines.ingest(found, contents, log, providers.PlainTextParser(), pipelines.Providers(providers.HashEmbedder(8)), 8, as_of(), LIMITS)
    assert {r["doc_id"]: (r["status"], r["chunk_count"]) for r in got.log.collect()} == {"a": ("SUCCESS", len(chunking.segments(texts["a"], LIMITS))), "b": ("SUCCESS", 1)}
    assert {r["chunk_level"] for r in got.chunks.where("doc_id = 'a'").collect()} == {"split"}


def _long_pages(spark, doc_id: str):
    return spark.createDataFrame([(doc_id, i, False, None, f"Page {i}. " + "Another sentence of it. " * 30, ["text"], f"Part {i}") for i in (1, 2)], PAGES)


def test_long_sections_are_cut(spark):
    contents = spark.createDataFrame([("a", 0, "One", 1), ("a", 1, "Two", 2)], CONTENTS)
    got = chunking.chunk_documents(_long_pages(spark, "a"), contents, LIMITS).orderBy("chunk_index").collect()
    for page, title in ((1, "One"), (2, "Two")):
        own = [r for r in got if r["section_title"] == title]
        assert [r["chunk_text"] for r in own] == chunking.segments(f"{title}\n\nPage {page}. " + "Another sentence of it. " * 30, LIMITS)
        assert {(r["chunk_level"], r["page_start"], r["page_end"]) for r in own} == {("split", page, page)}
    assert [r["chunk_index"] for r in got] == list(range(len(got))) and {r["chunk_total"] for r in got} == {len(got)}


def test_levels_of_long_groups_of_pages(spark):
    chunks = chunking.chunk_documents(_long_pages(spark, "b"), spark.createDataFrame([], CONTENTS), LIMITS)
    expected = sum(len(chunking.segments(f"Part {i}\n\nPage {i}. " + "Another sentence of it. " * 30, LIMITS)) for i in (1, 2))
    assert [tuple(r) for r in chunking.level_summary(chunks).collect()] == [("split", expected)]


def test_vectors_as_text_round_as_sql_does(spark):
    ties = [1 / 512, 3 / 512, -5 / 512, 0.103515625, 0.166015625, 0.0, -0.0, 1e-10, -1e-10, 0.1, 8388607.5, 2.0**60]
    got = spark.createDataFrame([(ties,)], "v array<float>").select(vectors.to_text("v").alias("t")).first()["t"]
    assert got == duckdb.execute("SELECT '[' || array_to_string(list_transform(CAST(? AS FLOAT[]), lambda x: printf('%.8f', CAST(x AS DOUBLE))), ',') || ']'", [ties]).fetchone()[0]


def _long_table(spark, n: int = 20_000):
    """Cells of one table of n rows and a header, and its rows once merged cells are filled."""
    cells = [["Id", "Name", "Note"], *([str(i), f"name {i}" if i % 3 == 1 else "", f"note {i}" if i % 5 == 4 else None] for i in range(n))]
    filled = cells[:1]
    for row in cells[1:]:
        filled.append([c or above for c, above in zip(row, filled[-1], strict=True)])
    return tables.process_tables(spark.createDataFrame([(cells,)], "cells array<array<string>>").coalesce(1)), filled


def test_a_table_of_many_rows_as_markdown(spark):
    df, filled = _long_table(spark)
    got = within(spark, 60, lambda: df.select("markdown", "row_count", "has_header").first())
    widths = [max(3, *(len(r[i]) for r in filled)) for i in range(3)]
    lines = ["| " + " | ".join(c.ljust(w) for c, w in zip(r, widths, strict=True)) + " |" for r in filled]
    assert (got["markdown"].split("\n"), got["row_count"], got["has_header"]) == ([lines[0], "|" + "|".join("-" * (w + 2) for w in widths) + "|", *lines[1:]], len(filled), True)


def test_a_table_of_many_rows_as_plain_text(spark):
    df, filled = _long_table(spark)
    got = within(spark, 60, lambda: df.select("plain_text").first())
    assert got["plain_text"].split("\n") == [" | ".join(f"{h}: {c}" for h, c in zip(filled[0], r, strict=True) if c) for r in filled[1:]]


def test_a_cell_is_cleaned_once(spark):
    cells = [None, "", " a\tb\u00ad¶ c ", "x" * 500, "y" * 501]
    df = spark.createDataFrame([(c,) for c in cells], "c string").select(text.clean_cell(F.col("c")).alias("c"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("¶") == 1
    assert [r["c"] for r in df.collect()] == ["", "", "a b c", "x" * 500, "y" * 497 + "…"]


def test_long_texts_are_cut_some_at_a_time():
    texts = ["A sentence of a long text. " * 60, None, "short", *["Another sentence of it. " * 40] * 500]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])
    got = list(chunking.cut_rows(iter([batch]), LIMITS, ["id", "n", "total", "text"]))
    assert max(len(set(b["id"].to_pylist())) for b in got) <= chunking.ROWS and len(got) > 5
    rows = [tuple(r.values()) for b in got for r in b.to_pylist()]
    assert rows == [(i, n, len(parts), x) for i, t in enumerate(texts) for parts in [chunking.segments(t, LIMITS) if t else []] for n, x in enumerate(parts)]


def test_very_long_texts_are_cut_fewer_at_a_time():
    texts = ["Another sentence of it. " * 50_000] * 10
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])
    rows = [b.column("id").to_pylist() for b in chunking.cut_rows(iter([batch]), LIMITS, ["id", "n", "total", "text"])]
    assert [sorted(set(r)) for r in rows] == [[0, 1, 2], [3, 4, 5], [6, 7, 8], [9]]
    assert sum(map(len, rows)) == len(texts) * len(chunking.segments(texts[0], LIMITS))


class Kept:
    """A state variable of one key in memory."""

    def __init__(self):
        self.value, self.by_key, self.listed = None, {}, []

    exists = lambda self: self.value is not None
    get = lambda self: self.value if self.value is not None else iter(self.listed)
    getValue = lambda self, k: self.by_key[k]
    put = lambda self, rows: setattr(self, "listed", list(rows))
    appendList = lambda self, rows: self.listed.extend(rows)

    def update(self, value):
        self.value = value

    def updateValue(self, k, value):
        self.by_key[k] = value

    def clear(self):
        self.value, self.by_key, self.listed = None, {}, []


def test_requests_wait_in_blocks(spark):
    held, timers = {}, set()
    kept = lambda name, *_: held.setdefault(name, Kept())
    handle = SimpleNamespace(getMapState=kept, getListState=kept, getValueState=kept, registerTimer=timers.add, deleteTimer=timers.discard)
    grants = shared_quota.Grants(5, 1e9, 1000, 100)
    grants.init(handle)
    n = 20_000
    asked = random.Random(0).sample(range(n), n)
    grants.handleInputRows(("d",), ({"ts_ms": t, "request": t, "tokens": 1.0, "status": 200} for t in asked), None)
    assert len(held["coming"].by_key) == -(-n // in_order.BLOCK) and timers == {0}
    got, now = [], -1
    for now in (9_999, 19_999, 10**9):
        timers.clear()
        got += grants.handleExpiredTimer(("d",), SimpleNamespace(getCurrentWatermarkInMs=lambda: now), None)  # noqa: B023
    assert [r["request"] for r in got] == list(range(n)) and not held["coming"].by_key and not held["waiting"].by_key and not timers
    assert [r["granted_ms"] for r in got] == [i // 5 * 1000 + i % 5 for i in range(n)]


def test_a_bucket_answers_some_rows_at_a_time():
    rows = [(t / 7, float(t % 13), 429 if t % 101 == 0 else 200) for t in range(30_000)]
    shuffled = random.Random(1).sample(rows, len(rows))
    frames = [pd.DataFrame(shuffled[i : i + 10_000], columns=["ts", "tokens", "status"]).assign(deployment="d") for i in range(0, len(rows), 10_000)]
    stream = SimpleNamespace(groupBy=lambda _: SimpleNamespace(applyInPandasWithState=lambda run, *_: run))
    states = []
    got = list(quota.throttle(stream, 600.0, 5000.0, 20.0)(("d",), iter(frames), SimpleNamespace(exists=False, update=states.append)))
    assert max(len(f) for f in got) <= 8192
    bucket, expected = Bucket(600.0, 5000.0, 20.0, 100.0, 5000 / 6), []
    for ts, tokens, status in sorted(rows):
        wait = 0.0
        if status == 429:
            bucket = bucket.refused(ts, 2.0)
        else:
            bucket, wait = bucket.ask(ts, tokens)
            bucket = bucket if wait else bucket.succeeded()
        expected.append(("d", ts, tokens, status, status == 200 and wait == 0, wait, bucket.multiplier))
    assert [tuple(r) for f in got for r in f.itertuples(index=False)] == expected
    assert states[-1] == (bucket.requests, bucket.tokens, bucket.last, bucket.cooldown, bucket.multiplier)
