"""Quality rules, vector codes and the prefix trie against plain versions of themselves."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

pytest.importorskip("public_tokenizers")
from quillspark.llm import oracle, prefix_trie, quality_rules, vector_codes  # noqa: E402

DOCS = "doc_id long, text string, digest string, votes string, kept boolean, posterior double, n_words int, _n int"


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "x", "y", None, 0.5, -1, 3) for i, t in texts], DOCS)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_measures(text):
    text = text or ""
    words = words_of(text)
    at = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(at)
    covered = {i + j for i, w in enumerate(at) if often[w] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if words_of(x)]
    return {
        "n_words": len(words),
        "word_chars": len("".join(words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_lines": len(lines),
        "n_distinct_words": len(set(words)),
        "n_bare_words": sum(not re.search(r"[0-9A-Za-z\x80-\U0010ffff]", w) for w in words),
        "n_upper": len(re.findall(r"[A-Z]", text)),
        "n_lower": len(re.findall(r"[a-z]", text)),
        "n_stops": len(re.findall(r"[.!?]", text)),
    }


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("ab #é\n日\r\x0b.|Z　", max_size=60), min_size=1, max_size=5))
def test_measures(texts):
    got = quality_rules.measured(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert {k: int(v[i]) for k, v in got.items()} == plain_measures(t)


def plain_fit(votes, counts):
    """The same estimates, a combination of votes and a rule at a time."""
    rules = range(len(votes[0]))
    likely = [1 - (v.count(-1) + 0.1) / (v.count(-1) + v.count(1) + 1) for v in votes]
    share, good, bad, last = 0.5, [0.9] * len(rules), [0.9] * len(rules), None
    for step in range(quality_rules.ROUNDS):
        if step:
            likely = []
            for v in votes:
                a, b = share, 1 - share
                for j in rules:
                    a *= {1: good[j], -1: 1 - good[j], 0: 1}[v[j]]
                    b *= {1: 1 - bad[j], -1: bad[j], 0: 1}[v[j]]
                likely.append(a / (a + b))
        last = [share, *good, *bad]
        share = (sum(n * x for n, x in zip(counts, likely, strict=True)) + 9) / (sum(counts) + 10)
        for j in rules:
            said = {(v, side): sum(n * (x if side else 1 - x) for n, x, w in zip(counts, likely, votes, strict=True) if w[j] == v) for v in (1, -1) for side in (0, 1)}
            cast = said[1, 1] + said[-1, 1]
            good[j] = (said[1, 1] + 0.99 * (cast + 10)) / (2 * cast + 10)
            bad[j] = max((said[-1, 0] + 1) / (said[1, 0] + said[-1, 0] + 2), 1 - good[j])
        if max(abs(a - b) for a, b in zip(last, [share, *good, *bad], strict=True)) < 1e-9:
            break
    return share, good, bad


def test_estimates_equal_a_plain_version():
    rng = np.random.default_rng(5)
    truth = rng.random(4000) < 0.8
    votes = np.stack([np.where(rng.random(4000) < 0.3, 0, np.where(rng.random(4000) < right, 1, -1) * np.where(truth, 1, -1)) for right in (0.95, 0.9, 0.85, 0.97)], 1)
    some, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality_rules.fit(some, counts.astype(float))
    share, good, bad = plain_fit([tuple(map(int, v)) for v in some], counts.tolist())
    assert np.allclose([model.share, *model.good, *model.bad], [share, *good, *bad], atol=1e-6)
    odds = math.log(share / (1 - share)) + ((votes == 1) @ np.log(np.array(good) / (1 - np.array(bad)))) + ((votes == -1) @ np.log((1 - np.array(good)) / np.array(bad)))
    assert ((odds > 0) == truth).mean() > 0.9


def prose(n, seed):
    rng = np.random.default_rng(seed)
    said = ["".join(rng.choice(list("abcdefghilmnorstu"), rng.integers(2, 8))) for _ in range(n)]
    return " ".join(w + ("." if i % 12 == 11 else "") for i, w in enumerate(said))


def test_op11(spark):
    clean = [(i, prose(80, i)) for i in range(120)]
    symbols = [(1000 + i, " ".join(w + " $$$" for w in prose(60, 500 + i).split())) for i in range(12)]
    edges = [(2000, None), (2001, ""), (2002, " \n\t"), (2003, "ten words but of one kind " * 40), (2004, prose(30000, 9)), (0, clean[0][1]), (3, "another text of this id"), (None, prose(70, 7))]
    copies = [(3000 + i, prose(90, 77)) for i in range(300)]
    rows = clean + symbols + edges + copies
    got = quality_rules.judge(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append(r)
    for i, text in rows:
        wanted = plain_measures(text)
        failed = wanted["n_words"] < 10 or 100 * wanted["n_repeat_words"] > 20 * wanted["n_words"]
        own = [r for r in by_id[i] if all(r[m] == wanted[m] for m in wanted)]
        assert own and own[0]["base_failed"] == failed and not (failed and own[0]["kept"]) and 0 <= own[0]["posterior"] <= 1
    assert all(r["kept"] for i, _ in clean[1:] if i != 3 for r in by_id[i]) and all(by_id[i][0]["kept"] for i, _ in copies)
    assert not any(by_id[i][0]["kept"] for i, _ in symbols)
    assert quality_rules.judge(documents(spark, [])).collect() == []


def test_op11_copies_teach_once(spark):
    rows = [(i, prose(80, i)) for i in range(60)] + [(100 + i, " ".join(w + "#" for w in prose(50, 300 + i).split())) for i in range(6)]
    model = lambda r: quality_rules.learn(quality_rules.with_votes(quality_rules.measure(documents(spark, r))))
    alone, copied = model(rows), model(rows + [(500 + i, rows[-1][1]) for i in range(200)])
    assert alone.share == copied.share and np.array_equal(alone.good, copied.good) and np.array_equal(alone.bad, copied.bad)


def test_op11_finds_labelled_quality(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality_rules.judge(docs).join(labels.dropDuplicates(["doc_id"]), "doc_id").where("not base_failed").groupBy("quality", "kept").count().collect()
    n = {(r["quality"], r["kept"]): r["count"] for r in got}
    assert n.get((1, True), 0) > 0.99 * (n.get((1, True), 0) + n.get((1, False), 0)) and n.get((0, False), 0) > 0.9 * (n.get((0, False), 0) + n.get((0, True), 0))


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 70), st.integers(1, 5), st.integers(1, 6), st.integers(0, 1 << 30))
def test_nearest_entries(entries, length, width, seed):
    rng = np.random.default_rng(seed)
    book, x = rng.integers(-width, width + 1, (entries, length)), rng.integers(-2 * width, 2 * width, (200, length))
    found, far = vector_codes.nearest(vector_codes.Tree(book), x)
    every = ((x[:, None] - book[None]) ** 2).sum(2)
    assert (found == every.argmin(1)).all() and (far == every.min(1)).all()  # argmin takes the first of equal ones


def plain_codes(rows, parts, entries, rounds):
    q = {k: [math.floor(256 * e) for e in v] for k, v in rows.items()}
    length = len(next(iter(q.values()))) // parts
    cut = {k: [v[p * length : (p + 1) * length] for p in range(parts)] for k, v in q.items()}
    books = [[cut[k][p] for k in sorted(q)[:entries]] for p in range(parts)]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda p, x: min(range(len(books[p])), key=lambda e: (distance(books[p][e], x), e))
    for _ in range(rounds):
        given_ = {}
        for k in q:
            for p in range(parts):
                given_.setdefault((p, near(p, cut[k][p])), []).append(cut[k][p])
        for (p, e), own in given_.items():
            books[p][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    code = {k: "".join(f"{near(p, cut[k][p]):02x}" for p in range(parts)) for k in q}
    error = {k: sum(min(distance(b, cut[k][p]) for b in books[p]) for p in range(parts)) for k in q}
    return code, error, ",".join(str(c) for b in books for e in b for c in e)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", 5, 6) for i, v, lab in rows], "vec_id long, embedding array<double>, label int, code string, error int, _n int")


def test_op12(spark):
    rng = np.random.default_rng(3)
    rows = {i * 3: np.round(rng.normal(size=8) * (0.02 if i % 4 else 1), 2).tolist() for i in range(150)}  # many ties
    rows |= {900 + i: rows[0] for i in range(40)}
    label = lambda i: None if i % 5 == 0 else i % 3
    broken = [(1, None, 1), (2, [0.1] * 7 + [None], 1), (4, [0.1] * 7 + [math.nan], None), (5, [0.1] * 7 + [math.inf], 2)]
    odd = [(7, [], 1), (8, [0.5] * 6, 1), (None, rows[3], 2)]
    code, error, named = plain_codes(rows, 4, 16, 2)
    given_ = [(i, v, label(i)) for i, v in rows.items()] + broken
    codes, books = vector_codes.compress(vectors(spark, given_), parts=4, entries=16)
    assert vector_codes.digest(books) == hashlib.sha256(named.encode()).hexdigest()
    got = {r["vec_id"]: r for r in vector_codes.with_label_error(codes).collect()}
    assert set(got) == set(rows)
    for i in rows:
        assert (got[i]["code"], got[i]["error"]) == (code[i], error[i])
        assert got[i]["label_error"] == sum(error[j] for j in rows if label(j) == label(i))
    back = {r["vec_id"]: r["embedding"] for r in vector_codes.decode(codes, books).collect()}
    for i, v in rows.items():
        assert sum((math.floor(256 * a) - math.floor(256 * b)) ** 2 for a, b in zip(v, back[i], strict=True)) == error[i]
    extra = vector_codes.compress(vectors(spark, given_ + odd), parts=4, entries=16)[0].where("vec_id in (7, 8) or vec_id is null").collect()
    assert sorted((r["vec_id"] or -1, r["code"] is None) for r in extra) == [(-1, False), (7, True), (8, True)]


def test_op12_edges(spark):
    few, books = vector_codes.compress(vectors(spark, [(4, [1e300] * 16, None), (4, [-1e300] * 16, None), (9, [0.0] * 16, 3)]))
    got = vector_codes.with_label_error(few).collect()
    assert len(got) == 3 and all(r["error"] == 0 for r in got) and books.shape == (16, 3, 1) and np.abs(books).max() == vector_codes.LIMIT
    none, books = vector_codes.compress(vectors(spark, []))
    assert books is None and vector_codes.with_label_error(none).collect() == []
    nameless, books = vector_codes.compress(vectors(spark, [(None, [1.0] * 16, 1)]))
    assert books is None and [r["code"] for r in nameless.collect()] == [None]


def plain_trie(conversations, period=20, kinds=4):
    turns = {}
    for c, t, role, text in conversations:
        if c is not None:
            turns.setdefault(c, []).append(((t is not None, t or 0), role or "", text or ""))
    own = {c: [(r, x) for _, r, x in sorted(v, key=lambda y: y[0])] for c, v in turns.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % kinds
        rebuilt[c] = own.get(c - int(math.fmod(c, period)), [])[:h] + own[c][h:]
    members, nodes = {}, {}
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    children = Counter(k[:-1] for k in members if k)
    for k in members:
        below = [x for x in members if x[: len(k)] == k]
        saved = sum((len(members[x]) - 1) * len(words_of(x[-1][1])) for x in below if x)
        ends = ",".join(str(c) for c in sorted(members[k]) if len(rebuilt[c]) == len(k))
        nodes[k] = (min(members[k]), len(k), min(members[k[:-1]]) if k else None, len(members[k]), children[k], sum(not children[x] for x in below), saved, hashlib.sha256(ends.encode()).hexdigest())
    return sorted(nodes.values(), key=repr)


CONV = "conv_id long, turn long, role string, text string, depth int, digest string, words int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def made_conversations():
    rng = np.random.default_rng(8)
    said = ["a b c", "hello  there", "", None, "x", "deux　mots", "two\nlines here"]
    rows = []
    for c in [*range(45), 60, 61, 75, *range(100000, 100030), *range(1001, 1015), -5, -20]:
        for t in range(int(rng.integers(1, 6))):
            rows.append((c, t, [None, "user", "assistant"][int(rng.integers(3))], said[int(rng.integers(len(said)))]))
    rows += [(7, None, "system", "first of all")] + [(200 + i, t, "user", f"same {t}") for i in range(40) for t in range(3)]
    rows += [(500, t, "user", f"long {t // 2}") for t in range(300)] + [(501, t, "user", f"long {t // 2}") for t in range(280)]
    return rows


def test_op13(spark):
    rows = made_conversations()
    nameless = [(None, 1, "user", "no conversation"), (None, None, None, None)]
    df = spark.createDataFrame([(*r, 1, "d", 2) for r in rows + nameless], CONV)
    got = prefix_trie.trie(prefix_trie.with_openings(prefix_trie.numbered(df), 20, 4)).select(COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_trie(rows)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows + nameless)
    stated = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({oracle.OP13})").fetchall()
    assert sorted(stated, key=repr) == plain_trie(rows)


def test_op13_edges(spark, monkeypatch):
    assert prefix_trie.trie(prefix_trie.as_they_are(prefix_trie.numbered(spark.createDataFrame([], CONV)))).collect() == []
    monkeypatch.setattr(prefix_trie, "PACKED_BITS", 2)  # ids of a node come in many rows
    rows = [(i, t, "user", "same") for i in range(-9, 60) for t in (0, 0, None)]  # repeated and missing numbers
    df = spark.createDataFrame([(*r, 1, "d", 2) for r in rows], CONV)
    got = prefix_trie.trie(prefix_trie.as_they_are(prefix_trie.numbered(df))).select(COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_trie(rows, kinds=1)
