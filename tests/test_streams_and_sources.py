"""Quota, discovery, page ranges, grid and sections against plain versions."""

import json
import random
import time
import uuid
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.operators import batching, chunking, layout, quota
from quillspark.plans import pipelines
from quillspark.sources import discovery, pdf, store
from quillspark.streaming import events


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5), st.floats(5, 30), st.lists(st.tuples(st.integers(0, 40), st.floats(0, 30), st.booleans()), max_size=40))
def test_no_period_holds_more_than_its_limits(requests, tokens, asked):
    pace, granted, at = quota.Pace(requests, tokens, period=100), [], 0
    for gap, n, refused in asked:
        at += gap
        if refused:
            pace.refused(at, 50)
        elif n <= tokens:
            t = pace.earliest(at, n)
            assert t >= at and t >= pace.cooldown
            pace.grant(t, n)
            granted.append((t, n))
    for t, _ in granted:
        inside = [n for g, n in granted if t - 100 < g <= t]
        assert len(inside) <= requests and (sum(inside) <= tokens + 1e-9 or len(inside) == 1)


def logging_provider(folder):
    """A class of a function travels to the workers by value."""

    class Logging:
        """A provider that notes when it is called, refuses some first calls, and texts with "bad" always."""

        def __init__(self, folder):
            self.folder = str(folder)

        def __call__(self, texts):
            with open(f"{self.folder}/{uuid.uuid4().hex}", "w") as f:
                json.dump([time.time(), sum(max(1, len(t) // 4) for t in texts), len(texts)], f)
            if any("bad" in t for t in texts):
                raise batching.ProviderError("refused", 400)
            first = f"{self.folder}/../seen-{zlib.crc32(repr(texts).encode())}"
            try:
                open(first, "x").close()
            except FileExistsError:
                return [[1.0, float(len(t))] for t in texts]
            if random.Random(texts[0]).random() < 0.3:
                raise batching.ProviderError("slow down", 429, delay=0.05)
            return [[1.0, float(len(t))] for t in texts]

    return Logging(folder)


def test_all_tasks_keep_one_quota(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    rows = spark.createDataFrame([(i, f"text {i} " + ("bad" if i == 7 else "x" * (i % 30))) for i in range(60)], "id long, t string")
    how = batching.Calls(batch_size=4, batch_tokens=30, attempts=4, rpm=4, tpm=60, workers=3, period_ms=2500)
    got = {r["key"]: r["status"] for r in batching.embed(rows, "id", "t", logging_provider(calls), 2, how).collect()}
    assert got == {str(i): "FAILED" if i == 7 else "SUCCESS" for i in range(60)}
    seen = sorted(json.load(open(f)) for f in calls.iterdir())
    for at, _, _ in seen:  # noted some milliseconds after they are sent
        inside = [n for t, n, _ in seen if at - 2.4 < t <= at]
        assert len(inside) <= 4 and sum(inside) <= 60
    assert max(k for _, _, k in seen) <= 4


def test_discovery_goes_on_after_a_restart(spark, tmp_path):
    path, out, offsets = (f"file://{tmp_path}/{n}" for n in ("table", "out", "offsets"))
    for start in (0, 100, 100, 200):
        if start != 100 or not (tmp_path / "twice").exists():
            spark.range(start, start + 90).select("id", F.when(F.col("id") % 3 == 0, 1.0).alias("v")).write.mode("append").parquet(path)
            (tmp_path / "twice").touch() if start == 100 else None
        events.run_to_parquet(discovery.new_ids(spark, path, "id", "v", page=7), out, offsets)  # the third run finds nothing new
    ids = sorted(r["id"] for r in spark.read.schema("id long").parquet(out).collect())
    assert ids == [i for s in (0, 100, 200) for i in range(s, s + 90) if i % 3]
    few = f"file://{tmp_path}/few"
    events.run_to_parquet(discovery.new_ids(spark, path, "id", most=25), few, f"file://{tmp_path}/offsets-few")
    assert sorted(r["id"] for r in spark.read.schema("id long").parquet(few).collect()) == list(range(25))


def made_documents():
    return {"one": "# Start\nfirst page\fsecond page\n\nhere\f\0", "empty": "", "many": "\f".join(f"page {i} has some words that are its own" for i in range(1, 31))}


def test_pages_are_read_by_ranges(spark, tmp_path):
    files = store.written_files(spark.createDataFrame([(k, bytearray(v.encode())) for k, v in made_documents().items()], "doc_id string, content binary"), "made")
    missing = files.unionByName(spark.createDataFrame([("gone", f"file://{tmp_path}/gone")], "doc_id string, path string"))
    got = pdf.parse_ranges(missing, pdf.TextPages(), pages=4)
    rows = {(r["doc_id"], r["page"], r["kind"], r["text"], r["error"] and r["error"][:6]) for r in got.collect()}
    assert ("one", 1, "toc", "Start", None) in rows and ("one", 2, "text", "here", None) in rows and ("one", 3, None, None, "page 3") in rows
    assert sum(r[0] == "many" for r in rows) == 30 and any(r[0] == "gone" and r[1] is None and r[4] for r in rows)
    assert got.where("doc_id = 'many'").select(F.spark_partition_id()).distinct().count() > 1
    whole = pdf.parse(spark.createDataFrame([(k, bytearray(v.encode())) for k, v in made_documents().items()], "doc_id string, content binary"), pdf.TextPages())
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, got.where("doc_id <> 'gone'").collect()))


def test_a_bad_page_is_left_out_of_its_file(spark):
    now = F.lit("2024-01-15 00:00:00").cast("timestamp")
    contents = store.written_files(spark.createDataFrame([(k, bytearray(v.encode())) for k, v in made_documents().items()], "doc_id string, content binary"), "made")
    files = contents.select("doc_id", F.col("doc_id").alias("file_name"), F.col("path").alias("file_path"), F.lit("h").alias("file_hash"), F.lit(5).cast("long").alias("file_size"), now.alias("last_modified"), F.lit(True).alias("readable"))
    log = spark.createDataFrame([], "doc_id string, status string, retry_count int, file_hash string, last_modified timestamp, ingested_at timestamp, updated_at timestamp, error_message string, chunk_count int, pages_total int")
    from quillspark.operators.providers import HashEmbedder

    got = pipelines.ingest(files, contents, log, pdf.TextPages(), pipelines.Providers(HashEmbedder(8)), 8, now, chunking.Limits(least=1, section_least=1))
    rows = {r["doc_id"]: (r["status"], r["pages_total"]) for r in got.log.collect()}
    assert rows["one"] == ("SUCCESS", 3) and rows["many"] == ("SUCCESS", 30) and rows["empty"][0] == "ERROR"
    text = " ".join(r["chunk_text"] for r in got.chunks.where("doc_id = 'one'").collect())
    assert "first page" in text and "here" in text


def test_small_images_do_not_count(spark):
    rows = [("d", 1, 0, "image", 0.0, 0.0, 40.0, 40.0, None), ("d", 1, 1, "text", 0.0, 50.0, 90.0, 60.0, "short"), ("d", 2, 0, "image", 0.0, 0.0, 400.0, 400.0, None), ("d", 3, 0, "image", None, None, None, None, None)]
    got = pipelines.analyse(spark.createDataFrame(rows, "doc_id string, page int, ordinal int, kind string, x0 double, y0 double, x1 double, y1 double, text string")).collect()
    assert {(r["page"], r["kind"], r["page_kind"]) for r in got} == {(1, "text", "native"), (2, "image", "scanned"), (3, "image", "scanned")}


def test_boxes_meet_in_cells(spark):
    rng = np.random.default_rng(1)
    x, y = rng.uniform(-50, 5000, (5000, 2)).T
    w, h = rng.uniform(0, 60, (5000, 2)).T
    x[:20], w[:20] = 0, 5000  # some rules across the page
    boxes = [(1, i, float(a), float(b), float(a + c), float(b + d)) for i, (a, b, c, d) in enumerate(zip(x, y, w, h, strict=True))] + [(2, 0, 0.0, 0.0, 9.0, 9.0), (2, 1, 3.0, 3.0, None, 9.0)]
    df = spark.createDataFrame(boxes, "page int, id int, x0 double, y0 double, x1 double, y1 double")
    left, right = df.where("id % 2 = 0"), df.where("id % 2 = 1")
    got = {(r["left_id"], r["right_id"]): r["share"] for r in layout.overlapping(left, right, ["page"], 5.0).collect()}
    grown = lambda i: (x[i] - 5, y[i] - 5, x[i] + w[i] + 5, y[i] + h[i] + 5)
    even, odd = np.arange(0, 5000, 2), np.arange(1, 5000, 2)
    a, b = np.array([grown(i) for i in even]), np.stack([x[odd], y[odd], x[odd] + w[odd], y[odd] + h[odd]], 1)
    common = np.prod([np.maximum(0, np.minimum(a[:, None, k + 2], b[None, :, k + 2]) - np.maximum(a[:, None, k], b[None, :, k])) for k in (0, 1)], axis=0)
    area = lambda z: (z[:, 2] - z[:, 0]) * (z[:, 3] - z[:, 1])
    share = common / np.minimum(area(a)[:, None], area(b)[None, :])
    wanted = {(int(even[i]), int(odd[j])): share[i, j] for i, j in np.argwhere(share > 0.01)}
    assert got.keys() == wanted.keys() and all(abs(got[k] - wanted[k]) < 1e-9 for k in got)
    assert layout.candidates(left, right, ["page"], 5.0).count() < 12 * len(wanted) < 2500 * 2500 / 20


def test_pages_find_their_entries(spark):
    rng = random.Random(3)
    contents, pages = [], []
    for d in range(30):
        count = rng.randint(1, 25)
        at = [rng.randint(1, count + 2) for _ in range(rng.randint(0, 9))]
        contents += [(str(d), i, f"t{i}", p) for i, p in enumerate(at if d % 3 == 0 else sorted(at))]
        pages += [(str(d), p, "text", 9) for p in range(1, count + 1) if rng.random() < 0.8 or p == count]
    made = spark.createDataFrame(pages, "doc_id string, page int, text string, position_ int")
    ranges = chunking.section_ranges(spark.createDataFrame(contents, "doc_id string, position int, title string, page int"), made.groupBy("doc_id").agg(F.max("page").alias("page_count")))
    found = chunking.in_sections(made, ranges)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    wanted = set()
    last = {d: max(p for k, p, *_ in pages if k == d) for d, *_ in pages}
    for d, i, title, p in contents:
        later = [q for k, j, _, q in contents if k == d and j == i + 1]
        end = min(later[0] - 1 if later else last[d], last[d])
        wanted |= {(d, q, title, p, end) for k, q, *_ in pages if k == d and p <= q <= end}
    assert {(r["doc_id"], r["page"], r["title"], r["start"], r["end"]) for r in found.collect()} == wanted
