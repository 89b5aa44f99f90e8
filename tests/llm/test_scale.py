"""What must not change with size: candidates of unrelated rows stay few, near pairs are found,
many languages fit, small groups of equal texts stay whole."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")
from quillspark.llm import bag_minhash, cap_filters, graph, kd_sharding, language_id  # noqa: E402


def unit(rng, n, dim=64):
    x = rng.standard_normal((n, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cosines_a_vector(spark, x):
    rows = spark.createDataFrame(pa.table({"node": np.arange(len(x)), "v": pa.array(x.tolist())})).select("node", F.lit("1").alias("label"), F.lit(x.shape[1]).alias("dim"), "v")
    listed = cap_filters._listed(rows.repartition(8), *cap_filters.shape(len(x), x.shape[1]), *cap_filters.listing(len(x)))
    groups = graph.candidate_groups(listed, cap_filters.signs_apart(cap_filters.SIMILAR)).groupBy("component").count()
    return (groups.agg(F.sum(F.col("count") ** 2)).first()[0] or 0) / len(x)


def test_op8_unrelated_vectors_are_not_compared(spark):
    rng = np.random.default_rng(0)
    assert cosines_a_vector(spark, unit(rng, 40_000)) < 200
    assert cosines_a_vector(spark, unit(rng, 5_000) + 0.5 * np.eye(64)[0]) < 200  # a mean cosine of 0.2


def test_op8_recall_of_planted_pairs(spark):
    rng = np.random.default_rng(1)
    first, other = unit(rng, 20_000), unit(rng, 2_000)
    other -= (other * first[:2000]).sum(1, keepdims=True) * first[:2000]
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    cosine = 0.98 + 1e-6
    every = np.concatenate([first, cosine * first[:2000] + np.sqrt(1 - cosine**2) * other])
    rows = spark.createDataFrame(pa.table({"vec_id": np.arange(len(every)), "embedding": pa.array(every.tolist()), "label": np.zeros(len(every), np.int64)}))
    found = cap_filters.near_vectors(rows).where("vec_id >= 20000 and component_id = vec_id - 20000").count()
    assert found >= 0.99 * 2000


def test_op8_components_of_any_size(spark):
    rng = np.random.default_rng(2)
    base = unit(rng, 6, 16)
    rows = [(i, (v * size).tolist(), 1) for i, (v, size) in enumerate((b, s) for b in base for s in (1.0, 1e-200, 1e200, 5e-310))]
    got = cap_filters.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {r["vec_id"]: r["component_id"] for r in got} == {i: i - i % 4 for i in range(24)}


def test_op10_pages_of_a_template_are_not_compared(spark):
    rng = np.random.default_rng(3)
    shared = [f"t{i}" for i in range(180)]  # a similarity of 0.42
    texts = [" ".join(shared + [f"w{w}" for w in rng.integers(0, 50_000, 120)]) for _ in range(1500)]
    near = texts[7].replace("t5 ", "")
    rows = spark.createDataFrame(list(enumerate([*texts, near])), "doc_id long, text string")
    sketched = bag_minhash.sketch(rows).withColumnRenamed("doc_id", "node")
    limit = bag_minhash.registers_apart(bag_minhash.SIMILAR, bag_minhash.BANDS * bag_minhash.BAND_ROWS)
    groups = graph.candidate_groups(sketched.select("node", "keys", "sketch"), limit, bag_minhash.SKETCH_BITS).groupBy("component").count()
    assert (groups.agg(F.sum(F.col("count") ** 2)).first()[0] or 0) < 20 * len(texts)  # of 1501 a document
    assert {r["doc_id"]: r["class_id"] for r in bag_minhash.near_duplicates(rows).where("not kept").collect()} == {1500: 7}


def test_sketches_agree_as_documents_do():
    rng = np.random.default_rng(4)
    of, h, counts = bag_minhash.bags(pa.array([" ".join(f"w{w}" for w in np.where(rng.random(400) < keep, np.arange(400), rng.integers(1000, 9000, 400))) for keep in (1.0, 0.98, 0.9)]))
    held = bag_minhash.signatures(of, h, counts, 3, 2000)
    apart = graph.words_apart(bag_minhash.SKETCH_BITS)[1](*[bag_minhash.sketches(held).view(np.uint64)] * 2)
    bags = [(h[of == i], counts[of == i]) for i in range(3)]
    for i in range(3):
        for j in range(3):
            true = bag_minhash.similarity(bags[i], bags[j])
            assert abs(apart[i, j] - 2000 * (1 - true) * 15 / 16) < 5 * np.sqrt(500) and abs(true - bag_minhash.overlaps([bags[i]], [bags[j]])[0, 0]) < 1e-6


@pytest.mark.parametrize("fold", [1, 2, 4])
def test_words_apart(spark, fold):
    rng = np.random.default_rng(fold)
    words = rng.integers(-(1 << 63), 1 << 63, (2, 30, 3), np.int64)
    words[1, :10] = words[0, :10]
    words[1, :5, 0] ^= np.int64(12)
    column, matrix = graph.words_apart(fold)
    rows = spark.createDataFrame([(i, a.tolist(), b.tolist()) for i, (a, b) in enumerate(zip(*words, strict=True))], "i int, a array<long>, b array<long>")
    got = [r["n"] for r in rows.select("i", column(F.col("a"), F.col("b")).alias("n")).orderBy("i").collect()]
    bits = lambda x: np.unpackbits(np.ascontiguousarray(x).view(np.uint8), bitorder="little").reshape(30, -1, fold)
    assert got == (bits(words[0]) != bits(words[1])).any(axis=2).sum(axis=1).tolist()
    assert np.diag(matrix(*words.view(np.uint64))).tolist() == got


def test_op3_with_300_languages(spark):
    rng = np.random.default_rng(5)
    said = [["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(12)] for _ in range(300)]
    text = lambda i: " ".join(rng.choice(said[i], 40))
    taught = spark.createDataFrame([(3 * i + k, text(i), f"l{i:03}") for i in range(300) for k in range(3)], "doc_id long, text string, lang string")
    model = language_id.learn(taught)
    asked = spark.createDataFrame([(i, text(i)) for i in range(300)] + [(None, text(299))], "doc_id long, text string")
    got = language_id.identify(asked, model).collect()
    assert len(model.languages) == 300 and sum(r["lang_pred"] == f"l{299 if r['doc_id'] is None else r['doc_id']:03}" for r in got) >= 298
    assert taught.select(language_id.held_out(F.lit(None).cast("long")).alias("x")).first()["x"] is False


def test_best_path_with_many_states():
    rng = np.random.default_rng(6)
    scores, codes = -10 * rng.random((50, 300)), rng.integers(0, 50, 70)
    starts = np.array([0, 20, 20, 70])
    got = language_id.best_path(scores, codes, starts, switch=3.0)
    for a, b in zip(starts, starts[1:], strict=False):
        total = lambda p, own: sum(scores[c, x] for c, x in zip(own, p, strict=True)) - 3.0 * sum(x != y for x, y in zip(p, p[1:], strict=False))
        state = np.zeros(300)
        for c in codes[a:b]:
            state = np.maximum(state, state.max() - 3.0) + scores[c]
        if b > a:
            assert abs(total(got[a:b].tolist(), codes[a:b]) - state.max()) < 1e-9


def test_op1_keeps_small_groups_of_equal_texts_whole(spark):
    rng = np.random.default_rng(7)
    rows = [(i, f"text {i} " + "x" * int(rng.integers(50, 900)), "en", f"src{int(rng.integers(20))}") for i in range(3000)]
    rows += [(4000 + 300 * g + i, f"shared {g} " * 20, "de", f"src{i}") for g in range(40) for i in range(int(rng.integers(2, 5)))]
    rows += [(90_000 + i, "hot text " * 12, "fr", f"src{i % 30}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = kd_sharding.shard(docs, shards=12)
    sizes = [r["b"] for r in got.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 12 and max(sizes) / min(sizes) < 1.1
    per_text = {r["text_crc32"]: r["n"] for r in got.where("doc_id between 4000 and 80000").groupBy("text_crc32").agg(F.countDistinct("shard").alias("n")).collect()}
    assert len(per_text) == 40 and set(per_text.values()) == {1}
    assert got.where("doc_id >= 90000").select("shard").distinct().count() > 1
