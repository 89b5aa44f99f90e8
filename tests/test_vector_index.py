"""The vector index against plain search: ties, copies, conditions, broken vectors, saved and loaded."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.operators import vector_index

SCHEMA = "id long, v array<double>, label int, list string, part int, rank int"


@pytest.fixture(scope="module")
def made(spark):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(12, 8))
    rows = {i: (centers[i % 12] + 0.3 * rng.normal(size=8)).tolist() for i in range(900)}
    rows |= {5000 + i: rows[50] for i in range(400)}  # a large group of copies
    rows |= {7000: [0.0] * 8, 7001: None, 7002: [1.0] * 3, 7003: [float("nan")] + [1.0] * 7, 7004: [None] * 8, 7005: [1e-200] * 8, 7006: [1e200] * 8}
    df = spark.createDataFrame([(i, v, i % 6, "x", 1, 2) for i, v in rows.items()], SCHEMA)
    return rows, df


def plainly(rows, asked, k, able):
    fine = {i: np.array(v, float) / np.abs(v).max() for i, v in rows.items() if v and len(v) == 8 and None not in v and np.isfinite(v).all() and any(v)}
    cosine = lambda a, b: round(float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)), 6)
    out = {}
    for q in asked:
        if q in fine:
            near = sorted((-cosine(fine[q], fine[i]), i) for i in fine if able(i))
            out[q] = [i for _, i in near[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("q", "rank").collect():
        out.setdefault(r["q"], []).append(r["id"])
    return out


@pytest.mark.parametrize("few", [False, True])
def test_exact_search_equals_all_pairs(spark, made, few):
    rows, df = made
    asked = [*range(0, 900, 30), 50, 5010, 7000, 7001, 7002, 7005]
    where, able = (F.col("label") == 4) & (F.col("id") < (40 if few else 9000)), lambda i: i % 6 == 4 and i < (40 if few else 9000)
    index = vector_index.build(df, "id", "v", lists=20, keep=("label",))
    queries = df.where(F.col("id").isin(asked)).select(F.col("id").alias("q"), F.col("v").alias("w"))
    got = found(vector_index.search(index, df, "v", queries, "q", "w", 8, where, probes=3, exact=True, decimals=6))
    assert got == plainly(rows, asked, 8, able)


def test_recall_of_approximate_search(spark, made, tmp_path):
    rows, df = made
    index = vector_index.build(df, "id", "v", lists=25)
    path = f"file://{tmp_path}/index"
    index.save(path)
    again = vector_index.load(spark, path, "id")
    queries = df.where("id < 900 and id % 50 = 0").select(F.col("id").alias("q"), F.col("v").alias("w"))
    truth = vector_index.search(again, df, "v", queries, "q", "w", 8, exact=True)
    probes = vector_index.probes_for(again, df, "v", queries, "q", "w", 8)
    near = vector_index.search(again, df, "v", queries, "q", "w", 8, probes=probes)
    assert 1 <= probes <= 25 and vector_index.recall(near, truth, "q", "id") >= 0.9
    assert all(len(x) == 8 for x in found(near).values()) and sum(index.sizes) == index.rows.count() == 1302


def test_an_index_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    index = vector_index.build(none, "id", "v")
    assert vector_index.search(index, none, "v", none.select(F.col("id").alias("q"), "v"), "q", "v").collect() == []
    one = spark.createDataFrame([(3, [1.0, 2.0], 1, "x", 1, 1)], SCHEMA)
    got = vector_index.search(vector_index.build(one, "id", "v"), one, "v", one.select(F.col("id").alias("q"), "v"), "q", "v")
    assert [(r["q"], r["id"], r["rank"]) for r in got.collect()] == [(3, 3, 1)]


def test_blocks_of_lists_and_queries(spark, made, monkeypatch):
    monkeypatch.setattr(vector_index, "BLOCK", 16)
    monkeypatch.setattr(vector_index, "QUERY_BLOCK", 2)
    rows, df = made
    index = vector_index.build(df.where("id < 900"), "id", "v", lists=4)
    asked = list(range(0, 900, 100))
    queries = df.where(F.col("id").isin(asked)).select(F.col("id").alias("q"), F.col("v").alias("w"))
    got = found(vector_index.search(index, df, "v", queries, "q", "w", 5, probes=1, exact=True, decimals=6))
    assert got == plainly({i: v for i, v in rows.items() if i < 900}, asked, 5, lambda i: True)
