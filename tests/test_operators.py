"""Pinned cases of operators, mostly those without SQL."""

import datetime as dt
import itertools
import random
import re
import uuid

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.functions import status, text
from quillspark.operators import batching, chunking, jobs, layout, ledger, providers, quota, rollup, tables, token_chunking
from quillspark import schema
from quillspark.plans import pipelines, profile
from quillspark.sources import extracted, files, pdf, sinks, store
from quillspark.streaming import backfill as stream

NOW = dt.datetime(2024, 1, 1, 12)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_rollup_of_documents(spark):
    rows = [("a1", "A", 0, True, None), ("a2", "A", 1, True, None), ("b1", "B", 0, True, None), ("b2", "B", 1, False, "INPUT_TOO_LONG"), ("c1", "C", 0, False, None), ("c2", "C", 1, False, None), ("o1", None, 0, False, None)]
    c = spark.createDataFrame(rows, "chunk_id string, doc_id string, i int, e boolean, note string")
    docs = rollup.per_document(c, F.col("doc_id"), F.col("e"), F.col("note").isNotNull(), F.col("doc_id"), F.lit(NOW))
    got = rollup.totals(docs).first()
    assert tuple(got) == (3, 1, 1, 1, 1, 7, 3, 4, 1)
    assert rollup.priorities(docs).first()["doc_id"] == "C"
    d = rollup.details(c, F.col("doc_id"), "B", F.col("i"), F.col("chunk_id"), {"e": F.col("e")}).collect()
    assert [r["e"] for r in d] == [True, False] and not d[0]["truncated"]


@pytest.mark.parametrize("total,embedded,stage", [(4, 4, "Complete"), (4, 3, "Partial"), (4, 1, "Partial"), (4, 0, "Not started"), (0, 0, "Unknown")])
def test_document_stage(spark, total, embedded, stage):
    assert one(spark, status.document_stage(F.lit(total), F.lit(embedded))) == stage


def test_job_phases(spark):
    tasks, wanted = [], {"a": "Active claims", "b": "Completed with failures", "c": "Discovering / awaiting worker", "d": "Pending / no active lease", "e": "No tasks discovered"}
    for job, counts in {"a": {"PENDING": 10, "RUNNING": 2, "SUCCESS": 8, "FAILED": 3}, "b": {"SUCCESS": 991, "FAILED": 9}, "c": {"SUCCESS": 40}, "d": {"SUCCESS": 10, "RUNNING": 1}}.items():
        tasks += [(job, i, s, "w", NOW + dt.timedelta(hours=1 if job == "a" else -1)) for s, n in counts.items() for i in range(n)]
    t = spark.createDataFrame(tasks, "job_key string, row_id int, status string, owner string, lease_until timestamp")
    j = spark.createDataFrame([(k, k != "c") for k in wanted], "job_key string, discovery_done boolean")
    got = {r["job_key"]: r for r in jobs.summaries(j, t, F.lit(NOW)).collect()}
    assert {k: r["phase"] for k, r in got.items()} == wanted
    assert got["a"]["progress"] == pytest.approx(11 / 23) and got["e"]["progress"] == 0


def test_claims_are_disjoint(spark):
    t = spark.createDataFrame([("j", i, "PENDING", None, None, None, 0) for i in range(8)], "job_key string, row_id int, status string, owner string, claim_token string, lease_until timestamp, attempts int")
    first = ledger.claim(t, "a", "t", F.lit(NOW), 90, 8)
    assert first.where("owner = 'a' and attempts = 1").count() == 8
    assert ledger.claimable(first, F.lit(NOW), 8).count() == 0
    locked = first.where("row_id = 3")
    assert ledger.renew(first, "a", F.lit(NOW + dt.timedelta(seconds=10)), 90, locked).where(F.col("lease_until") > F.lit(NOW + dt.timedelta(seconds=90))).count() == 7


def bad_is_400(texts):
    if any("bad" in t for t in texts):
        raise batching.ProviderError("HTTP 400", 400)
    return [[1.0]] * len(texts)


def test_a_bad_row_fails_alone():
    got = list(batching.call_isolating(bad_is_400, [("ok1", "x", 2), ("bad", "bad", 2), ("ok2", "y", 2)], wait=lambda s: None))
    assert [(r, s) for r, s, _, _ in got] == [("ok1", "SUCCESS"), ("bad", "FAILED"), ("ok2", "SUCCESS")]


class Reserved:
    def __init__(self):
        self.reserved, self.cooled, self.good = [], [], 0

    def reserve(self, tokens):
        self.reserved.append(tokens)

    def cooldown(self, seconds):
        self.cooled.append(seconds)

    def succeeded(self):
        self.good += 1


def test_quota_is_reserved_for_every_try_and_429_cools_down():
    calls, seen = [], Reserved()

    def provider(texts):
        calls.append(texts)
        if len(calls) == 1:
            raise batching.ProviderError("slow down", 429, 7.0)
        return [[1.0]]

    assert next(batching.call_isolating(provider, [("a", "x", 10)], wait=lambda s: None, throttle=seen))[1] == "SUCCESS"
    assert seen.reserved == [10, 10] and seen.cooled == [7.0] and seen.good == 1


def test_a_throttle_waits_until_its_bucket_grants():
    now, waits = [0.0], []

    def wait(seconds):
        waits.append(seconds)
        now[0] += seconds

    t = batching.Throttle(quota.Bucket(60, 600, 50, requests=1, tokens=50), lambda: now[0], wait)
    t.reserve(50)
    t.reserve(20)
    assert sum(waits) == pytest.approx(2.0)
    t.cooldown(9)
    t.reserve(1)
    assert now[0] >= 11 and t.bucket.multiplier == 0.8


@pytest.mark.parametrize("headers,seconds", [({"retry-after-ms": "1500", "Retry-After": "9"}, 1.5), ({"Retry-After": "9"}, 9.0), ({"Retry-After": "soon"}, 2.0), ({}, 2.0), ({"Retry-After": "0"}, 0.1)])
def test_retry_after(headers, seconds):
    assert batching.retry_after(headers) == seconds


def test_only_a_failed_write_runs_again():
    tries = []

    def write():
        tries.append(1)
        if len(tries) < 3:
            raise OSError("deadlock")
        return "done"

    assert store.retrying(write, wait=lambda s: None) == "done" and len(tries) == 3
    tries.clear()

    def fails():
        tries.append(1)
        raise OSError("deadlock")

    with pytest.raises(OSError):
        store.retrying(fails, attempts=6, wait=lambda s: None)
    assert len(tries) == 6


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(1, 30)), max_size=60))
def test_greedy_batches(spark, rows):
    rows = [(g, i, t) for i, (g, t) in enumerate(rows)]
    got = {(r["g"], r["o"]): r["batch"] for r in batching.greedy_batches(spark.createDataFrame(rows, "g long, o long, t long"), "g", "o", "t", 3, 25).collect()}
    state = {}
    for g, o, t in rows:
        number, size, total = state.get(g, (0, 0, 0))
        if size and (size == 3 or total + t > 25):
            number, size, total = number + 1, 0, 0
        state[g] = number, size + 1, total + t
        assert got[g, o] == number


def test_fatal_errors_are_raised():
    def provider(texts):
        raise batching.FatalProviderError("401", 401)

    with pytest.raises(batching.FatalProviderError):
        list(batching.call_isolating(provider, [("a", "x", 1)]))


def test_bucket():
    b = quota.Bucket(rpm=60, tpm=600, batch_tokens=50, requests=1, tokens=100)
    b, wait = b.ask(0, 100)
    assert wait == 0 and b.requests == 0
    same, wait = b.ask(0, 10)
    assert wait == 1 and same is b
    slow = b.refused(0, 500)
    assert slow.cooldown == 120 and slow.multiplier == 0.8 and slow.ask(60, 1)[1] == 60
    assert slow.succeeded().multiplier == pytest.approx(0.802)


@settings(max_examples=200, deadline=None)
@given(st.text("ab .\n?!", max_size=600))
def test_segments_cover_the_text(t):
    limits = chunking.Limits(target=80, overlap=10, most=120, least=5)
    got = chunking.segments(t, limits)
    body = t.strip()
    assert all(5 <= len(s) <= 120 and s in body for s in got)
    if len(body) <= 120:
        assert got == ([body] if len(body) >= 5 else [])


def test_sliding_window_edges(spark):
    limits = chunking.Limits(target=40, overlap=5, most=60, least=10)
    texts = {1: "x" * 9, 2: "x" * 10, 3: "x" * 60, 4: "x" * 61, 5: "one two three four five\n\n" + "y" * 60, 6: None}
    d = spark.createDataFrame(list(texts.items()), "id long, t string")
    got = {}
    for r in chunking.sliding_window(d, "id", "t", limits).orderBy("id", "chunk_index").collect():
        got.setdefault(r["id"], []).append(r["chunk_text"])
    assert set(got) == {2, 3, 4, 5}
    assert got[4] == chunking.segments(texts[4], limits) and got[5][0] == "one two three four five"


def test_chunks_by_contents_and_by_headings(spark):
    limits = chunking.Limits(target=100, overlap=10, most=300, least=10, section_least=20, pages=2)
    pages = [("a", i, i == 2, None, f"page {i} " + "w" * 60, ["text"], None) for i in range(1, 7)] + [("b", i, False, None, f"body {i} " + "v" * 40, ["text"], "Intro" if i == 1 else "Next" if i == 4 else None) for i in range(1, 8)]
    p = spark.createDataFrame(pages, "doc_id string, page int, is_blank boolean, error string, text string, content_types array<string>, heading string")
    toc = spark.createDataFrame([("a", 0, "One", 2), ("a", 1, "Two", 3), ("a", 2, "Three", 3), ("b", 0, "x", 1)], "doc_id string, position int, title string, page int")
    got = chunking.chunk_documents(p, toc, limits).orderBy("doc_id", "chunk_index").collect()
    a, b = [r for r in got if r["doc_id"] == "a"], [r for r in got if r["doc_id"] == "b"]
    assert [(r["section_title"], r["page_start"], r["page_end"]) for r in a] == [("Three", 3, 6)]
    assert [(r["section_title"], r["page_start"], r["page_end"]) for r in b] == [("Intro", 1, 2), ("Intro", 3, 3), ("Next", 4, 5), ("Next", 6, 7)]
    assert b[0]["chunk_text"].startswith("Intro\n\n") and b[0]["chunk_total"] == 4


def test_paragraphs_once(spark):
    t = "A  b\n\nc\n\n\n a B \n\n\xa0\n\nd"
    assert one(spark, text.dedup_paragraphs(F.lit(t))) == "A  b\n\nc\n\nd"


@pytest.mark.parametrize("t,n", [("short", 10), ("a. " * 40, 10), ("x" * 100, 10), ("p" * 35 + "\n\n" + "q" * 40, 10)])
def test_truncate(spark, t, n):
    got = one(spark, text.truncate_tokens(F.lit(t), n))
    assert len(got) <= max(len(t) if len(t) // 4 <= n else 4 * n, 4 * n) and t.startswith(got)


NUMBERED, NAMED = regex.compile(token_chunking.NUMBERED), regex.compile(token_chunking.NAMED, regex.I)


def depth_of(line, titles):
    """The depth of a line that is a heading; 0 for other lines, -1 for blank ones."""
    line = line.strip()
    if not line or len(line) > token_chunking.LONGEST_HEADING:
        return -(not line)
    number = NUMBERED.fullmatch(line)
    return 1 + number[1].count(".") if number else int(line.lower() in titles or NAMED.fullmatch(line) is not None)


def parts_of(pages, contents):
    """Units of a document in order: headings, runs of lines between them, and elements of other kinds.

    The contents' first entry of a page opens it. Blank and failed pages are
    passed over; a page without elements is its raw text.
    """
    titles = frozenset(e["title"].strip().lower() for e in contents)
    opens = {e["page"]: e for e in reversed(contents)}
    path = []
    for page in sorted((p for p in pages if not p.get("is_blank") and not p.get("error")), key=lambda p: p["page"]):
        if entry := opens.get(page["page"]):
            path[max(0, entry["level"] - 1) :] = [entry["title"]]
        found = [(e["kind"], e["text"]) for e in page["elements"] or [] if e["text"]]
        for kind, text in found or [(None, page.get("raw_text") or "")]:
            if kind != "text":  # whole, as it is
                if text.strip():
                    yield token_chunking.Part(text.strip(), page["page"], tuple(path), kind or "text")
                continue
            lines = [(line.strip(), depth_of(line, titles)) for line in text.splitlines()]
            # a run goes on while lines are neither headings nor blank
            for (depth, _), run in itertools.groupby(enumerate(lines), key=lambda x: (x[1][1], x[0] if x[1][1] > 0 else -1)):
                said = " ".join(line for _, (line, _) in run)
                if depth > 0:
                    path[depth - 1 :] = [said]
                if depth >= 0:
                    yield token_chunking.Part(said, page["page"], tuple(path), "text")


def filled_plainly(units, policy, tokenizer):
    """Chunks by joining one part after the other and measuring what comes."""
    size = lambda t: len(tokenizer.encode(t))

    def text(parts):
        body = "\n".join(p.text for p in parts)
        title = parts[0].path[-1] if policy.preserve_headers and parts[0].path else ""
        return body if not title or body.casefold().startswith(title.casefold()) else f"{title}\n\n{body}"

    done, held = [], []
    for unit in units:
        room = policy.max_tokens - 4 - (size(unit.path[-1] + "\n\n") if policy.preserve_headers and unit.path else 0)
        for t in token_chunking.within(unit.text, room, tokenizer):
            part = token_chunking.Part(t, unit.page, unit.path, unit.kind)
            full = bool(held) and size(text([*held, part])) > policy.max_tokens
            turned = bool(held) and held[-1].path != part.path
            if full or (turned and size(text(held)) >= policy.min_tokens):
                done.append(held)
                tail = token_chunking.Part(tokenizer.decode(tokenizer.encode(held[-1].text)[-policy.overlap_tokens :]), held[-1].page, held[-1].path, held[-1].kind)
                held = [tail] if full and not turned and policy.overlap_tokens and size(text([tail, part])) <= policy.max_tokens else []
            held.append(part)
    return [(text(h), {p.page for p in h}) for h in [*done, held] if h]


STRUCTURE = "doc_id string, pages array<struct<page:int,elements:array<struct<kind:string,text:string>>,is_blank:boolean,error:string,raw_text:string>>, contents array<struct<level:int,title:string,page:int>>"


def made_structures(n, seed):
    rng = random.Random(seed)
    line = ["1.2 Head x", "1 Top", "2.1.1 Deep", "3.1.4.1.5 Deepest of all", "SECTION z", "", "  ", "a, b. c", "Alpha", "beta ", "word " * 3, "word " * 25, "y" * 70, "x.", "y z!"]
    text = lambda: "\n".join(rng.choice(line) for _ in range(rng.randint(0, 7)))
    out = []
    for i in range(n):
        pages = [{"page": k, "elements": [{"kind": rng.choice(["text", "text", "table"]), "text": text()} for _ in range(rng.randint(0, 3))], "is_blank": rng.random() < 0.1, "error": "bad" if rng.random() < 0.1 else None, "raw_text": rng.choice([None, "raw text\nof lines"])} for k in range(1, rng.randint(1, 5))]
        rng.shuffle(pages)
        out.append((f"d{i}", pages, [{"level": rng.randint(0, 4), "title": rng.choice(["Alpha", "Beta"]), "page": rng.randint(1, 4)} for _ in range(rng.randint(0, 3))]))
    return out


@pytest.mark.parametrize("most,least,overlap,headers,by_pattern", [(20, 0, 4, True, False), (40, 5, 9, True, True), (60, 10, 0, False, False), (20, 5, 9, True, True)])
def test_token_chunks_are_filled_greedily(spark, most, least, overlap, headers, by_pattern):
    made = made_structures(150, most + least)
    policy, tokenizer = token_chunking.Policy(most, least, overlap, headers), pattern_tokenizer() if by_pattern else token_chunking.WordTokenizer()
    got = {}
    for r in token_chunking.chunk_documents(spark.createDataFrame(made, STRUCTURE), policy, tokenizer).orderBy("doc_id", "chunk_index").collect():
        got.setdefault(r["doc_id"], []).append(r)
    for doc, pages, contents in made:
        units = list(parts_of(pages, contents))
        rows = got.get(doc, [])
        if any(policy.max_tokens - 4 - (len(tokenizer.encode(u.path[-1] + "\n\n")) if headers and u.path else 0) < token_chunking.LEAST_ROOM for u in units):
            assert [r["error"] is not None for r in rows] == [True]
            continue
        wanted = filled_plainly(units, policy, tokenizer)
        assert [r["chunk_text"] for r in rows] == [t for t, _ in wanted]
        assert [(r["page_start"], r["page_end"]) for r in rows] == [(min(p), max(p)) for _, p in wanted]
        assert all(len(tokenizer.encode(r["chunk_text"])) <= most and r["chunk_total"] == len(rows) and r["error"] is None for r in rows)


def test_units_and_their_paths(spark):
    made = made_structures(120, 7)
    rows = token_chunking.units(spark.createDataFrame(made, STRUCTURE)).collect()
    for doc, pages, contents in made:
        own = sorted((r for r in rows if r["doc_id"] == doc), key=lambda r: tuple(r["at"]))
        assert [(r["text"], r["page"], tuple(r["path"]), r["kind"]) for r in own] == [(p.text, p.page, p.path, p.kind) for p in parts_of(pages, contents)]


def pattern_tokenizer():
    """A class of a function travels to the workers by value."""

    class Pieces:
        """Pieces of a published pattern: a mark takes the line end along, a word the space before it."""

        def __init__(self):
            self.pattern = regex.compile(token_chunking.PATTERNS["cl100k_base"])

        def encode(self, t):
            return self.pattern.findall(t)

        def decode(self, pieces):
            return "".join(pieces)

    return Pieces()


def within_plainly(t, room, tokenizer):
    """Word by word, measuring what is held."""
    if len(tokenizer.encode(t)) <= room:
        return [t]
    out, held = [], ""
    for word in re.findall(r"\S+\s*", t):
        if len(tokenizer.encode(word)) > room:
            out.append(held.strip())
            pieces, held = tokenizer.encode(word), ""
            out += [tokenizer.decode(pieces[i : i + room]) for i in range(0, len(pieces), room)]
        elif held and len(tokenizer.encode(held + word)) > room:
            out, held = [*out, held.strip()], word
        else:
            held += word
    return [x for x in [*out, held.strip()] if x]


@settings(max_examples=200, deadline=None)
@given(st.text("ab .,\n1-", max_size=200), st.integers(3, 30))
def test_parts_are_filled_word_by_word(t, room):
    assert token_chunking.within(t, room, pattern_tokenizer()) == within_plainly(t, room, pattern_tokenizer())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["x.", "y. z!", "1 Top", "word. " * 4, "a, b. c", "-" * 9 + ".", "one two three. " * 9]), max_size=20), st.sampled_from([20, 40, 60]), st.sampled_from([0, 5, 12]), st.sampled_from([0, 4, 9]))
def test_chunks_are_measured_as_they_are(texts, most, least, overlap):
    policy, pieces = token_chunking.Policy(most, least, overlap, True), pattern_tokenizer()
    units = [token_chunking.Part(t.strip(), i, ("1 Top",) if i % 5 else (), "text") for i, t in enumerate(texts)]
    filling, got = token_chunking.Filling(policy, pieces), []
    for u in units:
        room = most - 4 - (len(pieces.encode(u.path[-1] + "\n\n")) if u.path else 0)
        for t in token_chunking.within(u.text, room, pieces):
            got.append(filling.add(token_chunking.Part(t, u.page, u.path, u.kind), len(pieces.encode(t))))
    assert [filling.text(g) for g in [*got, filling.held] if g] == [t for t, _ in filled_plainly(units, policy, pieces)]


def test_a_document_that_cannot_be_cut_is_a_row(spark):
    rows = spark.createDataFrame([("bad", 1, "1 " + "Long heading " * 8 + "\nbody"), ("good", 1, "body " * 30)], "doc_id string, page int, t string")
    chunks, failed = pipelines.rechunk_settling(rows, {"doc_id": "doc_id", "text": "t", "page": "page"}, token_chunking.Policy(20, 5, 2))
    assert {r["doc_id"] for r in chunks.collect()} == {"good"} and [(r["doc_id"], "too long" in r["error"]) for r in failed.collect()] == [("bad", True)]


def test_charts_are_described_and_tables_have_their_context(spark):
    class Read:
        def __call__(self, images):
            return [("1 2 3" if i == b"chart" else "noise of many words that nobody is sure about", 0.5) for i in images]

    class Describe:
        def __call__(self, told):
            return [f"{x['image'].decode()} near <{x['context']}> with <{x['labels']}>" for x in told]

    class Echo:
        def __call__(self, shown):
            return [s.split("Text of the page:")[-1].strip() for s in shown]

    box = lambda y0, y1: (0.0, float(y0), 100.0, float(y1))
    cells = [["Name", "Dose"], *([f"row {i}", "some milligrams"] for i in range(8))]
    rows = [("d", 1, 0, "text", *box(0, 10), "axis 10 20 30", None, None, "native"), ("d", 1, 1, "image", *box(12, 80), None, None, bytearray(b"chart"), "native"), ("d", 1, 2, "image", *box(300, 390), None, None, bytearray(b"other"), "native"), ("d", 1, 3, "table", *box(400, 500), None, cells, None, "native")]
    made = spark.createDataFrame(rows, "doc_id string, page int, ordinal int, kind string, x0 double, y0 double, x1 double, y1 double, text string, cells array<array<string>>, image binary, page_kind string")
    made = store.stored(made, "made")
    got = {r["ordinal"]: (r["kind"], r["text"]) for r in pipelines.recognise(made, Read(), Describe()).collect()}
    assert got[1] == ("chart", "chart near <axis 10 20 30> with <1 2 3>\n\n[CHART LABELS/VALUES]\n1 2 3") and got[2] == ("image", "")
    tables_ = [r["text"] for r in pipelines.with_tables(made, Echo()).where("kind = 'table'").collect()]
    assert len(tables_) == 1 and "axis 10 20 30" in tables_[0]


def test_calls_that_fail_leave_the_others(spark):
    class Choosy:
        def __call__(self, values):
            if any("bad" in v for v in values):
                raise batching.ProviderError("refused", 400)
            return [(v.upper(), 0.5) for v in values]

    rows = spark.createDataFrame([(i, "bad" if i == 11 else f"v{i}") for i in range(40)], "id long, v string")
    got = {r["id"]: (r["said"], r["sure"]) for r in pipelines._called(rows, "v", Choosy(), "said string, sure double", "calls", batching.Calls(batch_size=5, workers=3)).collect()}
    assert got == {i: (None, None) if i == 11 else (f"V{i}", 0.5) for i in range(40)}


def test_paths_of_headings():
    pages = [{"page": 2, "elements": [{"kind": "text", "text": "1 One\nbody\n1.1 Sub\nmore\n\nnext"}]}, {"page": 1, "elements": [], "raw_text": "raw"}, {"page": 3, "elements": [{"kind": "text", "text": "x"}], "error": "bad"}]
    got = [(p.text, p.page, p.path) for p in parts_of(pages, [{"level": 1, "title": "Top", "page": 1}])]
    assert got == [("raw", 1, ("Top",)), ("1 One", 2, ("1 One",)), ("body", 2, ("1 One",)), ("1.1 Sub", 2, ("1 One", "1.1 Sub")), ("more", 2, ("1 One", "1.1 Sub")), ("next", 2, ("1 One", "1.1 Sub"))]


def test_tables(spark):
    cells = [["Name", "Dose"], ["a|b", "5"], [None, "6"], ["", ""], ["c" * 600, "7"]]
    r = spark.createDataFrame([(cells,)], "cells array<array<string>>")
    got = tables.process_tables(r).first()
    assert got["has_header"] and got["row_count"] == 4 and "| a|b " in got["markdown"] and got["rows"][2][0] == "a|b"
    assert got["rows"][3][0].endswith("…") and len(got["rows"][3][0]) == 498


def test_reading_order_of_two_columns():
    box = lambda x, y: {"x0": x, "y0": y, "x1": x + 50, "y1": y + 10}
    boxes = [box(300, 0), box(0, 3), box(0, 50), box(300, 80)]
    assert layout._order(boxes, 400) == [1, 0, 2, 3]
    assert layout._order([box(10, 12), box(0, 11), box(0, 0)], 400) == [2, 1, 0]


def test_profiles(tmp_path):
    p = tmp_path / "p.json"
    p.write_text('{"version": 1, "name": "x", "existing_chunks": {"schema": "s", "table": "t", "id_column": "i", "vector_column": "v"}}')
    got = profile.load(str(p), ["chunking.max_tokens=500"])
    assert got["chunking"]["max_tokens"] == 500 and got["_fingerprint"] == profile.fingerprint(got)
    assert [d["table"] for d in profile.datasets(str(tmp_path))] == ["t"]
    for bad in ("chunking.max_tokens=5", "chunking.min_tokens=801", "embedding.lease_seconds=100", "output.x=1"):
        with pytest.raises(ValueError):
            profile.load(str(p), [bad])
    assert profile.load(None) is None


def test_sinks_and_files(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    sinks.replace(spark.createDataFrame([(1, "a", "x"), (2, "b", "x")], "id long, t string, s string"), path)
    write = sinks.foreach_upsert(path, ["id"], ["t"])
    for _ in range(2):
        write(spark.createDataFrame([(2, "B", "y"), (3, "c", "y")], "id long, t string, s string"), 0)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a", "x"), (2, "B", "x"), (3, "c", "y")]
    parts = f"file://{tmp_path}/parts"
    sinks.bucketed(spark.range(40).selectExpr("id", "'old' t"), ["id"], 8).write.partitionBy("bucket").parquet(parts)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "parts").rglob("*.parquet")}
    for _ in range(2):
        sinks.foreach_upsert(parts, ["id"], ["t"], 8)(spark.createDataFrame([(3, "new"), (99, "new")], "id long, t string"), 0)
    got = {r["id"]: r["t"] for r in spark.read.parquet(parts).collect()}
    assert got == {i: "old" for i in range(40)} | {3: "new", 99: "new"}
    assert sum(p.exists() and p.stat().st_mtime_ns == n for p, n in before.items()) >= 6  # other buckets are as they were
    (tmp_path / "f").mkdir()
    (tmp_path / "f/a.PDF").write_bytes(b"1")
    (tmp_path / "f/b.txt").write_bytes(b"2")
    assert [r["file_name"] for r in files.crawl(spark, f"file://{tmp_path}/f").collect()] == ["a.PDF"]
    assert files.store_uri("s3://b/k/x") == ("b", "k/x") and files.store_uri("http://x") is None


def stand_ins():
    """Classes of a function travel to the workers by value."""

    class Parser:
        """A page of text, a scanned page, and a page with a table and a chart."""

        def __call__(self, content):
            if content == b"bad":
                raise ValueError("broken")
            box = lambda y: {"x0": 0.0, "y0": float(y), "x1": 100.0, "y1": float(y + 10)}
            if content == b"empty":
                return [], [{"page": 1, "kind": "text", "text": "x"} | box(0)]
            cells = [["Name", "Dose"], ["alpha", "5 mg and then some more words"], ["beta", "6 mg and then some more words"], ["gamma", "7 mg and then some more words"]]
            return [], [
                {"page": 1, "kind": "text", "text": "second " + "word " * 60} | box(50),
                {"page": 1, "kind": "text", "text": content.decode() + " " + "word " * 60} | box(0),
                {"page": 2, "kind": "image", "image": b"scan"} | box(0) | {"y1": 70.0},
                {"page": 3, "kind": "table", "cells": cells} | box(0),
                {"page": 3, "kind": "text", "text": "axis 10 20 30% " + "long text " * 20} | box(25),
                {"page": 3, "kind": "image", "image": b"chart"} | box(30) | {"y1": 60.0},
                {"page": 3, "kind": "image", "image": b"noise"} | box(300) | {"y1": 330.0},
            ]

    class Counting:
        """Writes a file for each text that it is asked for."""

        def __init__(self, folder):
            self.folder = folder

        def __call__(self, texts):
            for _ in texts:
                open(f"{self.folder}/{uuid.uuid4().hex}", "w").close()
            return providers.HashEmbedder(8)(texts)

    class Ocr:
        def __call__(self, images):
            return [{b"scan": ("scanned words " * 30, 0.9), b"chart": ("rising line of six words here", 0.5), b"noise": ("a b c d e f g", 0.5)}[i] for i in images]

    return Parser, Counting, Ocr


Parser, Counting, Ocr = stand_ins()


def test_ingest(spark, tmp_path):
    names = ["a", "bad", "empty", "done"]
    f = spark.createDataFrame([(n, f"{n}.pdf", f"/{n}.pdf", "h", 5, NOW, True) for n in names], "doc_id string, file_name string, file_path string, file_hash string, file_size long, last_modified timestamp, readable boolean")
    log = spark.createDataFrame([("done", "SUCCESS", 0, "h", NOW, NOW, NOW, None, 3, 1), ("bad", "ERROR", 1, "h", NOW, NOW, NOW, "old", 0, 0)], "doc_id string, status string, retry_count int, file_hash string, last_modified timestamp, ingested_at timestamp, updated_at timestamp, error_message string, chunk_count int, pages_total int")
    content = spark.createDataFrame([(n, bytearray(n.encode())) for n in names], "doc_id string, content binary")
    got = pipelines.ingest(f, content, log, Parser(), pipelines.Providers(Counting(tmp_path), Ocr(), providers.FirstWords(4)), 8, F.lit(NOW))
    chunks, rows = got.chunks.orderBy("chunk_index").collect(), {r["doc_id"]: r for r in got.log.collect()}
    assert {r["doc_id"] for r in chunks} == {"a"} and all(len(r["chunk_vector"]) == 8 and r["embedding_status"] == "SUCCESS" for r in chunks)
    text = "\n".join(r["chunk_text"] for r in chunks)
    assert text.index("a word") < text.index("second word") < text.index("scanned words") < text.index("| alpha")
    assert "[TABLE SUMMARY]\n| Name | Dose" in text and "[CHART]\nrising line" in text and "a b c d" not in text
    assert {k: (r["status"], r["error_message"], r["retry_count"]) for k, r in rows.items()} == {"a": ("SUCCESS", None, 0), "bad": ("ERROR", "broken", 2), "empty": ("ERROR", "no chunks", 0), "done": ("SUCCESS", None, 0)}
    assert rows["a"]["pages_total"] == 3 and rows["a"]["chunk_count"] == len(chunks) == len(list(tmp_path.iterdir()))
    assert pdf.parse(content, Parser()).where("error is not null").count() == 1


def test_backfill_sends_each_text_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, "text one", None), (2, " ", None), (3, "done", [1.0]), (4, "x" * 40_000, None), *((i, f"text {i}", None) for i in range(10, 30))], "id long, t string, v array<float>")
    out = {r["id"]: r["outcome"] for r in pipelines.backfill(rows, "id", "t", "v", Counting(tmp_path), 8).collect()}
    assert out == {1: "SUCCESS", 2: "SKIPPED/EMPTY_TEXT", 3: "SKIPPED/ALREADY_DONE", 4: "FAILED/INPUT_TOO_LONG"} | dict.fromkeys(range(10, 30), "SUCCESS")
    assert len(list(tmp_path.iterdir())) == 21
    assert pipelines.eligible(rows, "v") == 23 and pipelines.eligible(rows, "v", most=5) == 5
    assert [r["id"] for r in pipelines.discover(rows, "id", "v", after=4, page=2).collect()] == [10, 11]


def test_requests_stay_within_the_limits(spark):
    class Limited:
        def __call__(self, texts):
            assert len(texts) <= 3 and sum(max(1, len(t) // 4) for t in texts) <= 20
            return providers.HashEmbedder(8)(texts)

    rows = spark.createDataFrame([(i, "word " * (i % 16)) for i in range(1, 90)], "id long, t string").where("t <> ''")
    got = batching.embed(rows, "id", "t", Limited(), 8, batching.Calls(3, 20, workers=2, rpm=60_000, tpm=6_000_000))
    assert got.where("status = 'SUCCESS'").count() == rows.count()


def test_a_round_of_a_backfill(spark):
    source = spark.createDataFrame([(i, f"text {i}", None) for i in range(6)] + [(6, "refused", None)], "id long, t string, v array<float>")
    tasks = spark.createDataFrame([("j", i, "PENDING", None, None, None, 0, None, None, NOW) for i in [*range(7), 99]], "job_key string, row_id long, status string, owner string, claim_token string, lease_until timestamp, attempts int, error_code string, error_message string, updated_at timestamp")
    args = (source, tasks, "j", "me", "t1", F.lit(NOW), "id", "t", "v", providers.Refusing("refused", "bad"), 8)
    got = pipelines.backfill_round(*args, limit=20)
    assert {r["row_id"]: (r["status"], r["error_code"]) for r in got.tasks.collect()} == {i: ("SUCCESS", None) for i in range(6)} | {6: ("FAILED", "API_FAILURE"), 99: ("SKIPPED", "MISSING")}
    assert got.events.select("row_id").collect()[0][0] == 6
    # another worker has taken the tasks meanwhile: nothing of this round counts
    late = pipelines.backfill_round(*args, limit=20, latest=lambda: ledger.claim(tasks, "other", "t2", F.lit(NOW), 300, 20))
    assert late.tasks.where("status = 'RUNNING' and owner = 'other'").count() == 8


def test_mapped_tables_are_checked(spark):
    good = spark.createDataFrame([(1, "a", [1.0]), (2, "b", None)], "i long, t string, v array<float>")
    schema.validate_source(good, "i", "t", "v", 1)
    for bad, args in ((good, ("i", "t", "v", 2)), (good.union(good), ("i", "t", "v", 1)), (good, ("t", "i", "v", 1)), (good, ("i", "t", "x", 1))):
        with pytest.raises(ValueError):
            schema.validate_source(bad, *args)
    assert schema.identifier("a_1") == "`a_1`"
    with pytest.raises(ValueError):
        schema.identifier("a; drop")


def test_refused_vectors_and_new_rows_of_a_stream(spark, tmp_path):
    chunks = spark.createDataFrame([("c", [0.0, 0.0])], "chunk_id string, v array<double>")
    with pytest.raises(Exception, match="invalid vector in c"):
        sinks.checked_profile_chunks(chunks, "v", 2).collect()
    path, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    spark.createDataFrame([(1, "one"), (2, " ")], "id long, t string").write.parquet(path)
    for more in (0, 1):
        if more:
            spark.createDataFrame([(3, "three")], "id long, t string").write.mode("append").parquet(path)
        rows = spark.readStream.schema("id long, t string").parquet(path)
        stream.run_available(stream.embed_stream(rows, "id", "t", providers.HashEmbedder(4), 4), lambda df, n: df.write.mode("append").parquet(out), f"file://{tmp_path}/offsets")
    assert sorted(r["key"] for r in spark.read.parquet(out).collect()) == ["1", "3"]


def test_rechunk(spark):
    rows = spark.createDataFrame([("d", 1, "Title: Alpha\nbody " * 30), ("d", 2, "more " * 50)], "doc_id string, page int, t string")
    got = pipelines.rechunk(rows, {"doc_id": "doc_id", "text": "t", "page": "page"}, token_chunking.Policy(60, 10, 5), {"document": {"title": {"method": "label", "label": "Title"}}}).collect()
    assert got and all(r["effective_metadata"]["title"].startswith("Alpha") for r in got)
    assert extracted.documents(rows, {"doc_id": "doc_id", "text": "t"}).first()["file_path"] == "db://table/d"
