"""The stages of the pipeline on the smallest tables, each against what its operator decides."""

import os
import subprocess
import sys

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")
import corpus_pipeline  # noqa: E402
from quillspark.llm import bag_minhash, queries, substring_dedup, toxicity  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"file://{tmp_path}/{i}"
        before = docs
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        counts.append(docs.count())
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
            assert docs.select("doc_id").exceptAll(before.select("doc_id")).isEmpty()
        if i == 2:
            assert bag_minhash.near_duplicates(docs).where("not kept").isEmpty()
        if i == 3:
            wanted = substring_dedup.remove_repeats(before).select("doc_id", F.col("kept").alias("text"))
            assert wanted.exceptAll(docs.select("doc_id", "text")).isEmpty() and docs.where("n_chars <> length(text)").isEmpty()
    assert counts[0] > counts[1] >= counts[2] > counts[3] == counts[4] <= counts[5]
    assert counts[1] <= 192  # most of the eleven toxic documents that the labels know are found
    assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").isEmpty()


def test_repeated_rows_collapse(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "other words are here for you to read")], "doc_id long, text string")
    assert corpus_pipeline.drop_near_copies(spark, docs, FOLDER).count() == 2


def test_rows_without_an_id_and_other_texts_of_an_id_stay(spark):
    rows = [(None, "first words of a row without id"), (None, "and some more of another row"), (1, "a b c d e f g"), (1, "a b c d e f g"), (1, "here is another text of the same id"), (2, "a b c d e f g"), (2, "a third text of some words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in corpus_pipeline.drop_near_copies(spark, docs, FOLDER).collect()]
    assert sorted(got, key=str) == sorted({r for r in rows if r != (2, "a b c d e f g")}, key=str)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 90}x{i}" for i in range(60))
EDGES = [(1, LONG, "en", "s", 5), (1, LONG, "en", "s", 5), (2, LONG + " end", None, None, None), (3, None, "en", "s", None), (4, "", "en", "s", 0), (5, " \n ", None, "s", 3), (None, "a row without id", None, None, None), (None, None, None, None, None), (6, "12 34", "en", "s", 5), (7, "other words before " + LONG, "de", "s", 5)]
WANTED = {"toxicity": len(EDGES), "language": 5, "near_dedup": 7, "substring_dedup": len(EDGES), "packing": len(EDGES)}


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_edges_of_each_stage(spark, name, stage):
    docs = spark.createDataFrame(EDGES, SCHEMA)
    got = stage(spark, docs, FOLDER)
    assert got.count() == WANTED[name]
    assert stage(spark, docs.limit(0), FOLDER).count() == 0
    if name != "packing":
        assert got.columns == docs.columns and got.schema.simpleString() == docs.schema.simpleString()
    if name == "near_dedup":  # of the copies and near copies the first, all others, also rows that have no words
        assert sorted((r["doc_id"] or 0 for r in got.collect())) == [0, 0, 1, 3, 4, 5, 6]
    if name == "substring_dedup":
        texts = {r["doc_id"]: r["text"] for r in got.collect() if r["doc_id"]}
        assert texts[7] == "other words before" and texts[2] == "end" and texts[3] == texts[4] == texts[5] == ""


def test_stages_decide_as_plain_versions_do(spark):
    """Toxicity and language row by row by the models' own scores, near copies by all pairs, packing by its law."""
    from collections import Counter

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    model = toxicity.learn(docs, labels)
    clean = {r["doc_id"] for r in docs.collect() if toxicity.Model.scores(model, pa.array([r["text"]]))[0] < 0.5}
    assert {r["doc_id"] for r in stages["toxicity"](spark, docs, FOLDER).collect()} == clean
    assert {r["doc_id"] for r in stages["language"](spark, docs, FOLDER).collect()} == {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"])}
    bags, root = {}, {}
    for r in docs.collect():
        w = r["text"].split()
        bags[r["doc_id"]] = Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()
    for i in sorted(bags):
        root[i] = i
        for j in sorted(root):
            common = (bags[i] & bags[j]).total() if j < i else 0
            if common and common / (bags[i].total() + bags[j].total() - common) >= 0.8:
                low, high = sorted((root[i], root[j]))
                root = {k: low if v == high else v for k, v in root.items()}
    assert {r["doc_id"] for r in stages["near_dedup"](spark, docs, FOLDER).collect()} == {i for i in root if root[i] == i}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered(name):
    assert callable(queries.QUERIES[name])


HELD = """
import ctypes, re, sys
import numpy as np, pyarrow as pa
from quillspark.llm import bag_minhash, language_id

class Rows:  # hands out the function that a worker runs
    columns = schema = None
    def mapInArrow(self, run, schema):
        return run

def used():
    return sum(map(int, re.findall(r"Pss_Anon: +(\\d+)", open("/proc/self/smaps_rollup").read()))) // 1024

rng = np.random.default_rng(1)
texts = [" ".join(map(str, rng.integers(0, 5000, 40_000))) for _ in range(20)]
batch = pa.RecordBatch.from_arrays([pa.array(range(20)), pa.array(texts)], names=["doc_id", "text"])
run = bag_minhash._multisets(Rows(), 5)
for _ in run([batch]):
    pass
held = used()
pa.default_memory_pool().release_unused()
ctypes.CDLL(None).malloc_trim(0)
print(held - used())
"""


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_a_worker_gives_its_memory_back():
    """What is free after a task does not stay with a worker, which lives on beside its executor."""
    out = subprocess.run([sys.executable, "-c", HELD], capture_output=True, text=True, check=True, cwd=os.path.dirname(corpus_pipeline.__file__))
    assert int(out.stdout) < 10
