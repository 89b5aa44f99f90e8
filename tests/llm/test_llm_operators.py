"""Each training-data operator against a plain version of itself, on small tables with
nulls, empty, long and repeated texts, and columns whose names clash."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from quillspark.llm import bag_minhash, byte_bpe, cap_filters, fingerprints, graph, kd_sharding, language_id, packing, shared, substring_dedup, token_files, toxicity, words  # noqa: E402
from quillspark.llm.pieces import PieceEncoder  # noqa: E402

VOCAB = ["tion", "ing", "the", "of", "and", "réeux", "ß", "x1", "don't", "日本", "a,b", "ümlaut"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, score double, kept boolean, block long, part int"


def prose(n, seed):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(VOCAB) + rng.choice(VOCAB) for _ in range(n))


BASE = prose(120, 1)
TEXTS = {0: BASE, 1: BASE, 2: BASE + " one more", 3: None, 4: "", 5: "  \n\t ", 6: "word", 7: prose(9000, 2), 8: prose(40, 3) + " " + BASE, 9: prose(300, 4), 10: "a b c d", 11: "a b c d", 12: "  x  　y\r\n'quoted' it's 12ab", 13: "same " * 50, 14: "a<|endoftext|> b <|startoftext|>c"}


def frame(spark, texts, repeat=()):
    rows = [(i, t, "en", None if i % 3 == 0 else f"s{i % 2}", None, 9, 0.5, True, 7, 1) for i, t in texts.items()]
    return spark.createDataFrame(rows + [rows[i] for i in repeat], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, TEXTS).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("aZé'9 ,.\n\r\t 　ßא日́İ", max_size=40), min_size=1, max_size=6))
def test_encoders_agree_with_the_libraries(texts):
    import tiktoken
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoder, table = byte_bpe.codec(path, public_tokenizers.PATTERN)
    ranks = byte_bpe.read_ranks(path)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids, starts = encoder.encode(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        part = ids[starts[i] : starts[i + 1]]
        assert part.tolist() == own.encode_ordinary(t)
        assert table.decode(part).tobytes().decode() == t
    for name, is_words, as_text in (("byte_bpe_50k.json", False, False), ("word_bpe_49k.json", True, False), ("byte_bpe_50k.json", False, True)):
        tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        tokenizer.encode_special_tokens = as_text
        ids, starts = PieceEncoder(tokenizer, is_words).encode(pa.array(texts, pa.string()))
        for i, e in enumerate(tokenizer.encode_batch(texts, add_special_tokens=False)):
            assert ids[starts[i] : starts[i + 1]].tolist() == e.ids


def test_op1(spark, docs, none):
    got = kd_sharding.shard(frame(spark, TEXTS, repeat=[2]), shards=4).collect()
    assert len(got) == len(TEXTS) + 1 and {r["shard"] for r in got} <= set(range(4))
    for s in range(4):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    for r in got:
        data = (TEXTS[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 50 + 1).cast("int")).alias("text"), F.lit("hot").alias("source"), F.lit("en").alias("lang"))
    sizes = [r["b"] for r in kd_sharding.shard(many, shards=24).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 24 and max(sizes) / min(sizes) < 1.1
    assert kd_sharding.shard(none, shards=4).count() == 0


def cut_plainly(rows, shards, first=0):
    """(doc_id, shard) of rows of size and keys: the widest dimension at the exact weighted median."""
    if shards == 1 or not rows:
        return [(r["doc_id"], first) for r in rows]
    dim = max(kd_sharding.KEYS, key=lambda k: (max(r[k] for r in rows) >> 32) - (min(r[k] for r in rows) >> 32))
    half, total = shards // 2, sum(r["size"] for r in rows)
    target, below, cut = total * half / shards, 0, None
    keys = sorted({r[dim] for r in rows})
    for k in keys:
        w = sum(r["size"] for r in rows if r[dim] == k)
        if below + w >= target or k == keys[-1]:
            cut = k if abs(below + w - target) <= abs(below - target) else k - 1
            break
        below += w
    left, right = [r for r in rows if r[dim] <= cut], [r for r in rows if r[dim] > cut]
    return cut_plainly(left, half, first) + cut_plainly(right, shards - half, first + half)


@pytest.mark.parametrize("shards", [1, 7, 24])
def test_op1_cuts_are_exact(spark, shards):
    rng = np.random.default_rng(shards)
    rows = [(i, prose(int(rng.integers(0, 30)), i % 90), ["en", "de", None][i % 3], f"src{int(rng.integers(0, 25)) if i % 3 else 7}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    keys = kd_sharding._keys(kd_sharding.slim(docs, F.octet_length("text") + 8)).collect()
    got = {r["doc_id"]: r["shard"] for r in kd_sharding.shard(docs, shards, near=0, together=0).collect()}
    assert got == dict(cut_plainly(keys, shards))
    assert len({r["k_d_source"] >> 52 for r in keys}) > 4  # src1 and src10 differ in the ordered part


def test_op1_by_target_bytes(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab "), (F.col("id") % 9).cast("int")).alias("text"))
    got = kd_sharding.shard(docs, target_bytes=400).groupBy("shard").agg(F.sum("size").alias("b")).agg(F.count("b"), F.max("b")).first()
    assert got[0] == 150 and got[1] < 800


def test_op1_keeps_rows_without_an_id(spark):
    rows = spark.range(400).select(F.when(F.col("id") % 5 > 0, F.col("id")).alias("doc_id"), F.lit("same text").alias("text"))
    got = kd_sharding.shard(rows, shards=4).collect()
    assert len(got) == 400 and {r["shard"] for r in got} == set(range(4))
    assert sum(r["doc_id"] is None for r in got) == 80


def test_op2(spark, docs, none):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    got = {r["doc_id"]: r for r in byte_bpe.round_trip(docs, path, pattern).collect()}
    assert all(got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest() for i, t in TEXTS.items())
    tokens = byte_bpe.encode(docs, path, pattern)
    for r in tokens.collect():
        data = b"".join(np.array(r[c], "<i4").tobytes() for c in ("byte_start", "char_start", "char_end"))
        splits = sum(a < b for a, b in zip(r["char_start"][1:], r["char_end"], strict=False))
        assert (got[r["doc_id"]]["offsets_crc32"], got[r["doc_id"]]["n_split"]) == (zlib.crc32(data), splits)
    assert got[12]["n_split"] > 0
    ranks = {v: k for k, v in byte_bpe.read_ranks(path).items()}
    for r in tokens.where("doc_id in (9, 12)").collect():
        text, data = TEXTS[r["doc_id"]], TEXTS[r["doc_id"]].encode()
        for i, b, a, e in zip(r["ids"], r["byte_start"], r["char_start"], r["char_end"], strict=True):
            assert data[b : b + len(ranks[i])] == ranks[i]
            assert ranks[i] in text[a:e].encode()
    assert {r["doc_id"]: r["text"] for r in byte_bpe.decode(tokens, path, pattern).collect()} == {i: t or "" for i, t in TEXTS.items()}
    assert byte_bpe.round_trip(none, path, pattern).count() == 0


def test_op4(spark, docs, none):
    from pyarrow import fs
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    folder = shared.fresh_path(spark, "tokens")
    manifest = token_files.write(docs, path, 2, folder)
    got = {r["doc_id"]: tuple(r)[1:] for r in token_files.read(manifest).collect()}
    tokenizer, at, wanted = Tokenizer.from_file(path), 0, {}
    for i in sorted(TEXTS):
        ids = np.array(tokenizer.encode(TEXTS[i] or "", add_special_tokens=False).ids + [2], "<u4")
        assert i != 14 or 50256 in ids
        wanted[i] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert got == wanted
    store, name = fs.FileSystem.from_uri(manifest.orderBy("part").first()["file"])
    with store.open_input_file(name) as f:
        one = token_files.TokenFile(f)
        assert one.ids(int(one.docs[0])).tolist()[-1] == 2 and one.ids(-5) is None
        one_first = one.ids_at(0).tolist()
        for most in (1, 100, 1 << 20):
            assert [x.tolist() for x in one.every(most)] == [one.ids_at(i).tolist() for i in range(len(one.docs))]
        whole = bytearray(f.read_at(f.size(), 0))
    whole[int(one.starts[1]) + 9] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        token_files.TokenFile(pa.BufferReader(bytes(whole))).ids_at(1)
    assert token_files.TokenFile(pa.BufferReader(bytes(whole))).ids_at(0).tolist() == one_first
    assert token_files.write_and_read(none, path, 2).count() == 0


def test_op9(spark, docs, none):
    rows = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 0, 256).collect()
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in rows:
        ids = np.array(tokenizer.encode(TEXTS[r["doc_id"]] or "", add_special_tokens=False).ids + [0], "<u4")
        assert r["start"] == 256 * r["piece"] and r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    total = sum(r["length"] for r in rows)
    assert len(by) <= -(-total // 256) + 1
    for i in TEXTS:
        own = sorted((r["piece"], r["start"], r["length"]) for r in rows if r["doc_id"] == i)
        assert [p for p, _, _ in own] == list(range(len(own))) and all(n == 256 for _, _, n in own[:-1]) and own
    assert packing.pack_documents(none, public_tokenizers.path("word_bpe_49k.json"), 0, 256).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit(sizes):
    sizes = np.array(sorted(sizes, reverse=True), np.int64)
    bins, offsets = packing.best_fit(sizes, 50)
    for b in set(bins.tolist()):
        own = sorted(zip(offsets[bins == b], sizes[bins == b], strict=True))
        assert sum(s for _, s in own) <= 50 and all(o == sum(x for _, x in own[:i]) for i, (o, _) in enumerate(own))
    assert len(set(bins.tolist())) <= -(-int(sizes.sum()) * 2 // 50) + 1


def test_packing_tree_loses_no_merge(spark):
    """Small partitions, of which each leaves one bin that is not half full: the tree joins them."""
    sizes = [60] * 40 + [15] * 9
    pieces = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(sizes)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    rows = packing.pack(pieces, 100, part_rows=3).collect()
    by = Counter()
    for r in rows:
        by[r["sequence_id"]] += r["length"]
    assert len(rows) == len(sizes) and max(by.values()) <= 100 and len(by) == 40


def test_packing_tree_fills_nearly_full_bins(spark):
    """What one partition leaves goes into the last free place of another one's bins."""
    for sizes in ([255, 1], [255, 255, 1], [254, 255, 2]):
        pieces = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(sizes)], "doc_id long, piece int, start long, length long, ids_crc32 long")
        rows = packing.pack(pieces, 256, part_rows=1).collect()
        assert len(rows) == len(sizes) and len({r["sequence_id"] for r in rows}) == len(sizes) - 1


def test_packing_sends_on_as_many_bins_as_can_be_filled(monkeypatch):
    """Many underfull bins and few places for them: as many sequences as if no bin were closed before the root."""
    rng = np.random.default_rng(5)

    def tree(leaves, capacity):
        rows = []
        for i, sizes in enumerate(leaves):
            n = len(sizes)
            at = np.arange(n)
            rows.append(pa.table({"doc_id": at, "piece": pa.array(np.zeros(n), pa.int32()), "start": np.zeros(n, np.int64), "length": sizes, "ids_crc32": np.zeros(n, np.int64), "node": np.full(n, -1), "bin": at, "fill": sizes, "offset": np.zeros(n, np.int64)}))
        level, done = 0, 0
        while True:
            out = [packing._pack(t, capacity, (level << 40) + i, 0, packing._levels(len(rows)))[0] for i, t in enumerate(rows) if t.num_rows]
            for t in out:
                done += len({(r["node"], r["bin"]) for r in t.filter(t["closed"]).select(["node", "bin"]).to_pylist()})
            if len(rows) == 1:
                return done
            left = [t.filter(pa.compute.invert(t["closed"])) for t in out]
            rows = [pa.concat_tables(left[i : i + packing.FAN_IN]) for i in range(0, len(left), packing.FAN_IN)]
            level += 1

    for _ in range(20):
        leaves = [np.concatenate([rng.integers(51, 101, rng.integers(5, 60)), rng.integers(1, 51, 1)]).astype(np.int64) for _ in range(70)]
        monkeypatch.setattr(packing, "CARRY", 1)  # only what the levels above ask for
        few = tree(leaves, 100)
        monkeypatch.setattr(packing, "CARRY", 10**9)
        assert few == tree(leaves, 100)


def removed(texts, size):
    seen, out = set(), {}
    for i in sorted(texts):
        w = plain_words(texts[i])
        gone = [False] * len(w)
        for p in range(len(w) - size + 1):
            k = tuple(w[p : p + size])
            if k in seen:
                gone[p : p + size] = [True] * size
            seen.add(k)
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    return out


def test_op7_over_many_blocks(spark, monkeypatch):
    """Small blocks, groups and ranges: every exchange has many rows of each kind."""
    rng = np.random.default_rng(11)
    pool = [prose(25, 100 + i) for i in range(6)]
    texts = {int(i): " ".join([prose(int(rng.integers(0, 30)), 1000 + int(i)), *(pool[k] for k in rng.integers(0, 6, rng.integers(0, 3)))]) for i in range(120)}
    real = shared.slices
    monkeypatch.setattr(substring_dedup, "slices", lambda batches: real(batches, most=700))
    monkeypatch.setattr(substring_dedup, "RANGE_WORDS", 300)
    monkeypatch.setattr(substring_dedup, "GATHERED", 40)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substring_dedup.remove_repeats(frame(spark, texts).repartition(3), 20).collect()}
    assert got == removed(texts, 20)


@pytest.mark.parametrize("size", [20, 4])
def test_op7(docs, none, size):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substring_dedup.remove_repeats(docs, size).collect()}
    assert got == removed(TEXTS, size)
    kept = substring_dedup.filter_rows(docs, size)
    assert kept.columns == docs.columns and kept.where("shard = 9 and block = 7").count() == len(TEXTS)
    assert substring_dedup.remove_repeats(none).count() == 0


def bag(t, n=5):
    w = plain_words(t)
    return Counter(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else Counter()


def test_op10(spark, none):
    texts, rng = dict(TEXTS), np.random.default_rng(5)
    for i in range(20, 60):  # a group of near copies with one to four changes each
        w = BASE.split()
        for p in rng.choice(len(w), rng.integers(1, 5), replace=False):
            w[p] = f"new{i}"
        texts[i] = " ".join(w)
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = {i: bag(t) for i, t in texts.items()}
    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and (c := (sets[i] & sets[j]).total()) / (sets[i].total() + sets[j].total() - c) >= 0.8:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    for block in (bag_minhash.BLOCK, 16, 5):  # with smaller ones the group is compared by blocks
        got = [(r["doc_id"], r["class_id"]) for r in bag_minhash.near_duplicates(frame(spark, texts, repeat=[2]), block=block).collect()]
        assert sorted(got) == sorted([(i, find(i)) for i in texts] + [(2, find(2))])
    assert bag_minhash.near_duplicates(none).count() == 0


def test_op10_repeated_and_nameless_rows(spark):
    other = prose(60, 77)
    rows = [(1, BASE), (1, other), (1, BASE), (2, BASE + " more"), (3, other + " x"), (None, BASE), (4, None), (4, "")]
    got = [tuple(r) for r in bag_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got, key=str) == sorted([(1, 1, True)] * 3 + [(2, 1, False), (3, 1, False), (None, None, True), (4, 4, True), (4, 4, True)], key=str)


def test_op10_pairs_with_another_first_one_in_each_band(spark):
    rng = np.random.default_rng(1)
    pool = [[f"p{i}w{j}" for j in range(40)] for i in range(24)]
    draw = lambda: [w for i in rng.choice(len(pool), 12, replace=False) for w in pool[i]]
    texts = [" ".join(draw()) for _ in range(4000)]
    for _ in range(100):
        w = draw()
        texts.append(" ".join(w))
        for p in rng.choice(len(w), 10, replace=False):
            w[p] = f"new{len(texts)}"
        texts.append(" ".join(w))
    of, h, c = bag_minhash.bags(pa.array(texts))
    keys = bag_minhash.band_keys(bag_minhash.signatures(of, h, c, len(texts), 120), 30, 4)
    for x in range(4000, len(texts), 2):
        sets = bag(texts[x]), bag(texts[x + 1])
        if (common := (sets[0] & sets[1]).total()) / (sets[0].total() + sets[1].total() - common) < 0.8:
            continue
        once = (keys[:4000] == keys[x]).sum(axis=1) == 1
        bands = np.flatnonzero(keys[x] == keys[x + 1])
        before = [np.flatnonzero(once & (keys[:4000, k] == keys[x, k]))[:1] for k in bands]
        if all(map(len, before)):
            break
    else:
        pytest.fail("no such pair")
    chosen = [texts[i] for i in np.concatenate(before)]
    found = bag_minhash.near_duplicates(frame(spark, dict(enumerate([*chosen, texts[x], texts[x + 1]])))).collect()
    n = len(chosen)
    assert len(bands) >= 2 and {r["doc_id"]: r["class_id"] for r in found} == {**{i: i for i in range(n)}, n: n, n + 1: n}


def test_bag_minhash_is_unbiased():
    a = {f"e{i}": 1 + i % 7 for i in range(60)}
    b = {f"e{i}": 1 + (i * 3) % 5 for i in range(20, 90)}
    of, h, c = zip(*[(k, int.from_bytes(hashlib.blake2b(e.encode(), digest_size=8).digest(), "little"), n) for k, x in enumerate((a, b)) for e, n in x.items()], strict=True)
    held = bag_minhash.signatures(np.array(of), np.array(h, np.uint64), np.array(c), 2, 4000)
    exact = sum(min(a.get(e, 0), b.get(e, 0)) for e in {*a, *b}) / sum(max(a.get(e, 0), b.get(e, 0)) for e in {*a, *b})
    assert abs((held[0] == held[1]).mean() - exact) < 0.04


def test_op8(spark):
    rng = np.random.default_rng(8)
    base = rng.standard_normal((6, 16))
    rows = [(i, (base[i % 6] + rng.standard_normal(16) * 0.05).tolist(), i % 2) for i in range(300)]
    rows += [(300, [0.0] * 16, 1), (301, None, 1), (302, [float("nan")] + [1.0] * 15, 1), (303, rows[0][1], None), (304, rows[0][1], 0), (305, [1.0] * 3, 0), (306, [1.0, None] + [1.0] * 14, 0)]
    given_ = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({"v": F.lit(1), "node": F.lit("x"), "copies": F.lit(2)})
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in cap_filters.near_vectors(given_).collect()}
    assert got == {r["vec_id"]: (r["n_links"], r["component_id"]) for r in cap_filters.near_vectors(given_, block=20).collect()}
    assert cap_filters.near_vectors(given_.limit(0)).count() == 0
    good = {i: (np.float32(v).astype(float), label) for i, v, label in rows if label is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    links = {i: [j for j, (w, m) in good.items() if j != i and m == label and len(w) == len(v) and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.98] for i, (v, label) in good.items()}
    for i, _, _ in rows:
        seen, todo = {i}, [i]
        while todo:
            todo += (fresh := [j for j in links.get(todo.pop(), []) if j not in seen])
            seen.update(fresh)
        assert got[i] == (len(links.get(i, [])), min(seen))


def test_op8_repeated_and_nameless_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, "a"), (1, v, "a"), (1, [0.0, 0.0, 1.0], "a"), (2, [1.0, 2.0, 3.001], "a"), (2, None, "a"), (None, v, "b"), (7, v, "b"), (None, None, None)]
    got = [tuple(r) for r in cap_filters.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()]
    assert sorted(got, key=str) == sorted([(1, 2, 1, True), (1, 2, 1, True), (1, 0, 1, True), (2, 2, 1, False), (2, 0, 2, True), (None, 1, 7, None), (7, 1, 7, True), (None, 0, None, None)], key=str)


@pytest.mark.parametrize("seed", range(4))
def test_links_within_large_groups(spark, seed):
    """Points on a line, near if within 1: components, and counts of copies, against a plain search."""
    rng = np.random.default_rng(seed)
    rows = [(g, g * 1000 + i, 8, float(x), int(rng.integers(1, 3))) for g in range(3) for i, x in enumerate([rng.uniform(0, 60, 70), np.concatenate([rng.uniform(0, 1, 90), rng.uniform(5, 9, 6)]), rng.uniform(0, 9, 4)][g])]
    members = spark.createDataFrame(rows, "component long, node long, bytes long, x double, copies long")
    near = {n: {m: c for h, m, _, y, c in rows if h == g and m != n and abs(x - y) <= 1} for g, n, _, x, _ in rows}
    for count in (True, False):
        found = graph.links_within(members, lambda t: t["x"].to_numpy(), lambda a, b: np.abs(a[:, None] - b[None, :]) <= 1, block=8, count=count).collect()
        assert all(r["b"] is not None or count for r in found)
        if count:
            assert {r["a"]: r["n"] for r in found if r["b"] is None} == {n: sum(m.values()) for n, m in near.items() if m}
        joined = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame([(r["a"], r["b"]) for r in found if r["b"] is not None], "a long, b long")).collect()}
        for n in near:
            seen, todo = {n}, [n]
            while todo:
                todo += (fresh := [m for m in near[todo.pop()] if m not in seen])
                seen.update(fresh)
            assert joined.get(n, n) == min(seen)


def test_op3(spark, none):
    rng = np.random.default_rng(4)
    stems = {"aa": ["sha", "ing", "tho"], "bb": ["eau", "ié", "oux"], "gr": ["αβγ", "δε", "λμ"]}
    say = lambda lang, n: " ".join("".join(rng.choice(stems[lang], 2)) for _ in range(n))
    rows = [(i, say(lang, int(rng.integers(1, 60))), lang) for i, lang in enumerate(list(stems) * 60)]
    d = spark.createDataFrame([*rows, (900, None, "aa"), (901, "12 !!", "bb"), (903, "\u0301\u0308 \u0301", "aa"), (902, say("aa", 30) + " " + say("gr", 20), None)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in language_id.identify(d, language_id.learn(d.where(~language_id.held_out(F.col("doc_id"))))).collect()}
    assert sum(got[i]["lang_pred"] == lang for i, _, lang in rows) / len(rows) > 0.97
    assert got[900]["lang_pred"] == got[901]["lang_pred"] == got[903]["lang_pred"] == "und" and got[900]["score"] == 0
    assert [s["lang"] for s in got[902]["spans"]] == ["aa", "gr"] and [s["words"] for s in got[902]["spans"]] == [30, 20]
    blank = language_id.learn(none)
    assert language_id.identify(none, blank).count() == 0 and language_id.identify(d, blank).where("lang_pred = 'und'").count() == d.count()


def test_word_scores_are_sums_of_log_shares(spark):
    """Counts of n-grams by a dict and plain loops, hashed one by one."""
    texts = [("aa", "Shaing tho, ing-a 12"), ("aa", "ingé tho"), ("bb", "eau ié éau"), ("gr", "αβγ δε")]
    model = language_id.learn(spark.createDataFrame(texts, "lang string, text string"))
    spell = lambda w: re.sub(r"[^a-zéαβγδε]", "", w.lower()).encode()

    def buckets(word):
        for n in range(1, 5):
            padded = (b" " if n > 1 else b"") + word + b" "
            for i in range(len(padded) - n + 1):
                code = np.array([int.from_bytes(padded[i : i + n], "big") + (n << 56)], np.uint64)
                yield int(words.mix(code)[0] >> np.uint64(64 - language_id.BUCKET_BITS))

    counts = {x: np.full(1 << language_id.BUCKET_BITS, 0.5) for x in ("aa", "bb", "gr")}
    for lang, text in texts:
        for w in filter(None, map(spell, text.split())):
            for b in buckets(w):
                counts[lang][b] += 1
    logs = np.stack([np.log(c / c.sum()) for c in counts.values()], axis=1)
    logs -= logs.mean(axis=1, keepdims=True)
    text = "ing éau αβ tho γeau x"
    read = words.Words(pa.array([text]))
    got = model.of_words(language_id.Vocabulary(read))[read.codes]
    for row, w in zip(got, text.split(), strict=True):
        own = sum(logs[b] for b in buckets(spell(w))) / 2
        greek = w[0] in "αβγδε"
        able = np.array([not greek, not greek, greek])
        own = np.where(able, own, -1e3)
        assert row == pytest.approx(np.maximum(own - own.max(), -20))


def viterbi(scores, switch):
    best, back = scores[0].copy(), []
    for s in scores[1:]:
        step = best[:, None] - switch * (1 - np.eye(len(s)))
        back.append(step.argmax(axis=0))
        best = step.max(axis=0) + s
    path = [int(best.argmax())]
    for b in back[::-1]:
        path.append(int(b[path[-1]]))
    return path[::-1], float(best.max())


def test_paths_are_the_best():
    rng = np.random.default_rng(6)
    scores = rng.normal(size=(30, 3)) * 4
    codes = rng.integers(0, 30, 50)
    starts = np.array([0, 7, 7, 30, 50])
    label = language_id.best_path(scores, codes, starts, 2.0)
    for a, b in ((0, 7), (7, 30), (30, 50)):
        own, value = viterbi(scores[codes[a:b]], 2.0)
        mine = label[a:b]
        assert scores[codes[a:b], mine].sum() - 2.0 * (mine[1:] != mine[:-1]).sum() == pytest.approx(value)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _row(row, i, x, b)
    return row[-1]


def _row(row, i, x, b):
    out = [i]
    for j, y in enumerate(b, 1):
        out.append(min(row[j] + 1, out[-1] + 1, row[j - 1] + (x != y)))
    return out


@settings(max_examples=300, deadline=None)
@given(st.text("abc", max_size=8), st.text("abc", max_size=8))
def test_levenshtein_automaton(pattern, word):
    automaton = toxicity.LevenshteinAutomaton(pattern, 2)
    state = automaton.start
    for c in word:
        state = automaton.step(state, c)
    d = edits(pattern, word)
    assert automaton.distance(state) == (d if d <= 2 else None)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=11), min_size=1, max_size=5), st.lists(st.text("abc", min_size=4, max_size=8), max_size=3), st.lists(st.text("abcd", max_size=13), max_size=20))
def test_lexicon_finds_what_edit_distances_say(entries, stems, more):
    lexicon = toxicity.Lexicon(sorted({*entries}), sorted({*stems}), {})
    for word in [*more, *entries, *(s + "a" for s in stems), *(e[:-1] + "d" for e in entries)]:
        options = [(d, e) for e in entries if (d := edits(word, e)) <= toxicity.allowed(e)]
        options += [(d, e) for e in stems if word and (d := min(edits(word[:i], e) for i in range(len(word)))) <= toxicity.allowed_before(e)]
        best = min(options, default=None)
        assert lexicon.find(word) == (best and (best[1], best[0]))


def test_op5_learns_from_few_labels(spark):
    """A fortieth of the labels that the other tests have teach the same words."""
    rng = np.random.default_rng(10)
    word = lambda: "".join(rng.choice(["tha", "ing", "ouo", "sti"], 3))
    rows = [(i, " ".join([word() for _ in range(30)] + (["blockhead", word(), "nitwitted"] if i < 8 else [])), int(i < 8)) for i in range(60)]
    d = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.learn(d.select("doc_id", "text"), d.select("doc_id", "toxic"))
    assert model.lexicon.words == ["blockhead", "nitwitted"]
    assert {r["doc_id"] for r in toxicity.score(d, model).where("predicted = 1").collect()} == set(range(8))


def test_op5(spark, none):
    rng = np.random.default_rng(7)
    rows, labels = [], []
    for i in range(600):
        w = ["".join(rng.choice(["tha", "ing", "ouo", "sti"], 3)) for _ in range(int(rng.integers(5, 60)))]
        toxic = i % 6 == 0
        if toxic:
            w.insert(int(rng.integers(len(w))), ["blockhead", "nitwitted"][i % 12 // 6])
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    rows += [(700, "you blokhead tha"), (701, None), (702, "")]
    d, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*labels, (999, 1), (701, None)], "doc_id long, toxic int")
    model = toxicity.learn(d, known.where(~toxicity.held_out(F.col("doc_id"))))
    assert model.lexicon.words == ["blockhead", "nitwitted"]
    got = {r["doc_id"]: r for r in toxicity.score(d, model).collect()}
    assert all(got[i]["predicted"] == t for i, t in labels)
    assert got[700]["score"] > got[701]["score"] == got[702]["score"]
    assert toxicity.filter_rows(d, model).count() == len(rows) - sum(r["predicted"] for r in got.values())
    assert toxicity.score(none, toxicity.learn(none, known)).count() == 0


def test_op5_copies_teach_once(spark):
    rng = np.random.default_rng(8)
    prose = lambda: ["".join(rng.choice(["tha", "ing", "ouo", "sti"], 3)) for _ in range(30)]
    rows = [(i, " ".join([*prose(), *([["blockhead", "nitwitted"][i % 2], *prose()] if i < 100 else [])]), int(i < 100)) for i in range(600)]
    rows += [(i, " ".join([*prose(), "nitwitted"]), 0) for i in range(600, 616)]
    copy, other = " ".join(prose()), " ".join([*prose(), "blockhead"])
    rows += [(i, copy, 1) for i in range(1000, 1400)] + [(i, other, 0) for i in range(2000, 2200)] + [(1399, copy, 1)]
    d = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    assert toxicity.learn(d.select("doc_id", "text"), d.select("doc_id", "toxic")).lexicon.words == ["blockhead", "nitwitted"]


def plain_features(text, lexicon):
    """Finds one after the other, each looked at in its surroundings."""
    tokens = plain_words(text)
    spelled = [re.sub(r"[^a-z]", "", w.lower()) for w in tokens]
    marks = [bool(re.search(toxicity.QUOTES, w)) for w in tokens]
    finds = [(i, *f) for i, w in enumerate(spelled) if w and (f := lexicon.find(w))]
    if not finds:
        return [0.0] * 6
    value = {i: lexicon.weights[e] / (1 + d) for i, e, d in finds}
    span = toxicity.QUOTE_SPAN
    quoted = {i for i, _, _ in finds if any(marks[max(0, i - span) : i + 1]) and any(marks[i : i + span + 1])}
    bare = {i: (0.0 if i in quoted else v) for i, v in value.items()}
    near = max(sum(v for j, v in bare.items() if abs(i - j) <= toxicity.NEAR) for i in bare)
    sums = [sum(bare[i] for i, _, d in finds if d == 0), sum(bare[i] for i, _, d in finds if d > 0), sum(value[i] for i in quoted), near, len({e for _, e, _ in finds}), 100 * len(finds) / len(tokens)]
    return [float(np.log1p(x)) for x in sums]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["blockhead", "blokhead,", "nitwit", '"nitwitted"', '"', "a", "fine,", "dolt", "doltish", '"b', "Blockheads"]), max_size=40).map(" ".join), min_size=1, max_size=4))
def test_features_of_finds(texts):
    lexicon = toxicity.Lexicon(["blockhead", "nitwit"], ["dolt"], {"blockhead": 3.0, "nitwit": 2.0, "dolt": 1.5})
    got = toxicity.features(pa.array(texts), lexicon)
    for row, t in zip(got, texts, strict=True):
        assert row == pytest.approx(plain_features(t, lexicon))


def test_quotation_is_apart():
    lexicon = toxicity.Lexicon(["blockhead"], [], {"blockhead": 3.0})
    x = toxicity.features(pa.array(['he said "you blockhead" again', "you blockhead again", ""]), lexicon)
    assert x[0, 0] == 0 < x[0, 2] and x[1, 0] > 0 == x[1, 2] and not x[2].any()


def test_op6(spark, docs, none):
    got = {r["doc_id"]: r for r in fingerprints.edited_likeness(docs).collect()}
    order = sorted(TEXTS, reverse=True)
    assert set(got) == set(TEXTS)
    for i, n in zip(order, [*order[1:], order[0]], strict=True):
        a, b = TEXTS[i] or "", TEXTS[n] or ""
        half = len(a) // 2
        assert got[i]["n_chars"] == len(a) and got[i]["edited_sha256"] == hashlib.sha256((a[: len(a) - half] + b[:half]).encode()).hexdigest()
        assert 0 <= got[i]["near_next"] <= 1
    assert got[0]["fingerprint"] == got[1]["fingerprint"] and got[1]["near_next"] == 1
    assert fingerprints.edited_likeness(none).count() == 0
    assert {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(docs).collect()} == {i: r["fingerprint"] for i, r in got.items()}


def plain_sample(text, places):
    """The least value of each place, word by word, by the definition."""
    counts, out = Counter(plain_words(text)), []
    step = 0x9E3779B97F4A7C15
    one = lambda x: words.mix(np.array([x & (1 << 64) - 1], np.uint64))[0]
    halves = lambda x: (((int(x) >> 32) + 0.5) / 2**32, ((int(x) & 0xFFFFFFFF) + 0.5) / 2**32)
    for place in range(1, places + 1):
        least = np.inf
        for w, n in counts.items():
            h = int.from_bytes(xxhash.xxh3_128_digest(w.encode())[:8], "little")
            seed = int(one(h + place * step))
            (a, b), (c, d), (e, _) = halves(seed), halves(one(seed + step)), halves(one(seed - step))
            r, ln_c = -np.log(a * b), np.log(-np.log(c * d))
            t = np.floor(np.log(float(n)) / r + e)
            least = min(least, ln_c - r * (t - e) - r)
        out.append((int(one(int(np.float64(least).view(np.uint64)))) >> 32 | 1) if counts else 0)
    return out


def test_op6_by_the_definition(spark):
    texts = {1: "a b a c", 2: "", 3: "b b b d e a", 4: "a c a b", 9: prose(40, 6)}
    got = {r["doc_id"]: r for r in fingerprints.edited_likeness(frame(spark, {i: t for i, t in enumerate([texts.get(k, "") for k in range(10)])})).collect()}
    own = {i: plain_sample(texts.get(i, ""), fingerprints.PLACES) for i in range(10)}
    for i in range(10):
        a, b = texts.get(i, ""), texts.get((i - 1) % 10, "")
        edited = plain_sample(a[: len(a) - len(a) // 2] + b[: len(a) // 2], fingerprints.PLACES)
        spelled = "".join(f"{x:08x}" for x in own[i])
        assert got[i]["fingerprint"] == spelled and got[i]["edited_fingerprint"] == "".join(f"{x:08x}" for x in edited)
        assert got[i]["near_edited"] == np.mean(np.array(own[i]) == edited) and got[i]["near_next"] == np.mean(np.array(own[i]) == own[(i - 1) % 10])


def test_weighted_sampling_is_unbiased():
    a, b = "x x x y z w w", "x y y z v w w w"
    s = fingerprints.samples(pa.array([a, b]), 3000)
    ca, cb = Counter(a.split()), Counter(b.split())
    assert abs((s[0] == s[1]).mean() - (ca & cb).total() / (ca | cb).total()) < 0.04


def test_ids_are_cut_in_two_levels(spark):
    rng = np.random.default_rng(3)
    ids = sorted({int(x) for x in rng.integers(-(1 << 62), 1 << 62, 700)}) + [0, 0, 0]
    docs = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    for parts, coarse in ((1, 9), (7, 9), (24, 5), (200, 14)):
        ranged, n = shared.id_ranges(docs, parts, coarse)
        rows = sorted((r["doc_id"], r["part"], r["following"]) for r in shared.with_following(ranged, n).collect())
        assert [i for i, _, _ in rows] == sorted(ids) and all(0 <= p < n for _, p, _ in rows)
        by = {}
        for i, p, f in rows:
            by.setdefault(p, []).append((i, f))
        order = sorted(by)
        assert [p for _, p, _ in rows] == sorted(p for _, p, _ in rows) and len(order) > parts * 0.8
        for p, after in zip(order, [*order[1:], order[0]], strict=True):
            assert {f for i, f in by[p] if i == by[p][-1][0]} == {after}
            assert all(f is None for i, f in by[p] if i != by[p][-1][0])


def test_op6_over_many_ranges(spark, monkeypatch):
    texts = {i * 37: prose(int(n), i) for i, n in enumerate(np.random.default_rng(2).integers(0, 40, 90))}
    docs = frame(spark, texts)
    whole = sorted(map(tuple, fingerprints.edited_likeness(docs).collect()))
    monkeypatch.setattr(fingerprints, "TASK_BYTES", 1200)
    monkeypatch.setattr(shared.id_ranges, "__defaults__", (4,))
    assert sorted(map(tuple, fingerprints.edited_likeness(docs).collect())) == whole and len(whole) == 90


@pytest.mark.parametrize("small", [0, 100])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_with_hot_keys(spark, small, how):
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(300)] + [(900, "alone")], "id long, k string")
    table = rows.where("k <> 'alone'").groupBy("k").agg(F.count("id").alias("n"), F.min("id").alias("least"))
    got = {r["id"]: r["least"] for r in shared.join_hot(rows, table, ["k"], "id", "n", how=how, small=small).collect()}
    assert got == {i: 1 if i % 3 else i for i in range(300)} | ({900: None} if how == "left" else {})


def test_components(spark):
    rng = np.random.default_rng(9)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(400, 440)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: find(x) for x in linked}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab \n\x00é", max_size=30), max_size=5), st.sampled_from([3, 8, 1000]))
def test_words_in_parts(texts, part):
    w = words.Words(pa.array(texts, pa.string()), part)
    named = w.named()
    assert [[named[c].decode() for c in w.codes[a:b]] for a, b in zip(w.starts, w.starts[1:], strict=False)] == [plain_words(t) for t in texts]


def test_words_and_windows():
    w = words.Words(pa.array(["a  b c\x0b", "", "d e f"]))
    assert [w.named()[c] for c in w.codes] == [b"a", b"b", b"c", "d e".encode(), b"f"] and w.starts.tolist() == [0, 3, 3, 5]
    at, of = words.inside(w.starts, 2)
    assert at.tolist() == [0, 1, 3] and of.tolist() == [0, 0, 2]


def test_rows_without_an_id_stay(spark):
    """In the operators that order ids, a null id is the least."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = spark.createDataFrame([(None, BASE), (None, "x"), (5, BASE), (3, None)], "doc_id long, text string")
    ids = [3, 5, None, None]
    for got in (token_files.write_and_read(rows, path, 2), fingerprints.edited_likeness(rows), substring_dedup.remove_repeats(rows), packing.pack_documents(rows, public_tokenizers.path("word_bpe_49k.json"), 0).where("piece = 0")):
        assert sorted((r["doc_id"] for r in got.collect()), key=lambda x: (x is None, x)) == ids
    assert {r["doc_id"]: r["n_removed"] for r in substring_dedup.remove_repeats(rows).where("doc_id = 5").collect()} == {5: 120}
    alone = spark.createDataFrame([(None, "a b")], "doc_id long, text string")
    assert fingerprints.edited_likeness(alone).first()["near_next"] == 1


def test_a_very_long_text(spark):
    """One text of several parts (words.PART_BYTES) among short ones, in all operators that read words."""
    long = " ".join(f"{VOCAB[i % 10]}{i % 977}x" for i in range(700_000))
    assert len(long.encode()) > 5 << 20
    docs = spark.createDataFrame([(1, long, "en"), (2, long + " end", "en"), (3, "short text", "en"), (4, "ça va", "fr")], "doc_id long, text string, lang string")
    assert {r["doc_id"]: r["class_id"] for r in bag_minhash.near_duplicates(docs).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
    assert {r["doc_id"]: (r["n_words"], r["n_removed"] > 690_000) for r in substring_dedup.remove_repeats(docs).collect()} == {1: (700_000, True), 2: (700_001, True), 3: (2, False), 4: (2, False)}
    near = {r["doc_id"]: (r["n_chars"], r["near_next"]) for r in fingerprints.edited_likeness(docs).collect()}
    assert near[2][0] == len(long) + 4 and near[2][1] > 0.9
    assert [r["lang_pred"] for r in language_id.identify(docs, language_id.learn(docs)).where("doc_id <> 3").orderBy("doc_id").collect()] == ["en", "en", "fr"]
    lexicon = toxicity.Lexicon(["blockhead"], [], {"blockhead": 3.0})
    assert (toxicity.features(pa.array([long + " blockhead", "blockhead"]), lexicon)[:, 0] > 0).all()


def test_clashing_columns_and_repeated_rows_of_filters(spark):
    rows = [(1, "sha ing tho", "aa", 1, 0.5, "x", 3), (1, "sha ing tho", "aa", 1, 0.5, "x", 3), (2, None, "aa", None, None, None, None), (None, "eau ié", "bb", 0, 0.1, "y", 4)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int, score double, lang_pred string, predicted int")
    kept = language_id.filter_rows(d, language_id.learn(d))
    assert kept.columns == d.columns and sorted(map(tuple, kept.collect()), key=str) == sorted((r for r in rows if r[1]), key=str)
    assert [r["lang_pred"] for r in language_id.identify(d, language_id.learn(d)).orderBy("doc_id").collect()] == ["bb", "aa", "aa", "und"]
    model = toxicity.learn(d, d.select("doc_id", "toxic"))
    assert toxicity.filter_rows(d, model).columns == d.columns and toxicity.filter_rows(d, model).count() == 4
    assert toxicity.score(d, model).count() == 4
