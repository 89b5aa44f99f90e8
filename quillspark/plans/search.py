"""Queries on vectors and retrieval."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import vectors
from ..operators import batching, retrieval, rollup, vector_index
from .registry import Registry
from .standins import table

REGISTRY = Registry()
query = REGISTRY.query


def _vectors(spark, sf_dir):
    """Vectors with some missing and some zero."""
    v = F.col("embedding")
    m = lambda n: F.pmod("vec_id", F.lit(n)) == 0
    changed = F.when(m(17), None).when(m(19), F.transform(v, lambda x: F.lit(0.0).cast("float"))).otherwise(v)
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", changed.alias("v"))


CHANGED = "e AS (SELECT vec_id, label, CASE WHEN vec_id % 17 = 0 THEN NULL WHEN vec_id % 19 = 0 THEN list_transform(embedding, lambda x: CAST(0 AS FLOAT)) ELSE embedding END v FROM embeddings)"
QUERY_ROW = "q AS (SELECT CAST(embedding AS DOUBLE[]) q FROM embeddings WHERE vec_id = 1)"
TOP = "top AS (SELECT vec_id, label, round(list_cosine_similarity(CAST(v AS DOUBLE[]), q), 6) similarity FROM e, q WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x <> 0)) > 0 AND label IN (1, 2, 3) ORDER BY 3 DESC, 1 LIMIT 8)"


def _top(spark, sf_dir):
    one = table(spark, sf_dir, "embeddings").where("vec_id = 1").select(F.col("embedding").alias("q"))
    where = retrieval.matches("v", content_type=F.col("label").isin(1, 2, 3))
    return retrieval.top_k(_vectors(spark, sf_dir), one, "v", "vec_id", 8, where, decimals=6)


@query(f"WITH {CHANGED}, {QUERY_ROW}, {TOP} SELECT * FROM top")
def vector_topk_filtered(spark, sf_dir):
    return _top(spark, sf_dir).select("vec_id", "label", "similarity")


@query(f"""WITH {CHANGED} SELECT count(*) total, count(*) FILTER (len(list_filter(v, lambda x: x <> 0)) > 0) with_vector, count(*) FILTER (v IS NOT NULL AND len(list_filter(v, lambda x: x <> 0)) = 0) zero_vector,
  count(*) FILTER (v IS NULL OR len(v) = 0) empty_vector, round(avg(greatest(1, label // 4)), 1) avg_tokens, max(greatest(1, label // 4)) max_tokens FROM e""")
def vector_stats(spark, sf_dir):
    return rollup.vector_stats(_vectors(spark, sf_dir), "v", F.greatest(F.lit(1), F.floor(F.col("label") / 4).cast("int")))


@query(f"WITH {CHANGED} SELECT vec_id, coalesce(len(v) = 64 AND len(list_filter(v, lambda x: x <> 0)) > 0, FALSE) valid FROM e")
def vector_validity(spark, sf_dir):
    return _vectors(spark, sf_dir).select("vec_id", vectors.is_valid("v", 64).alias("valid"))


@query("SELECT DISTINCT source FROM documents WHERE source IS NOT NULL AND source <> ''")
def distinct_values(spark, sf_dir):
    return retrieval.distinct_values(table(spark, sf_dir, "documents"), "source")


@query(f"""WITH {CHANGED}, {QUERY_ROW}, {TOP}, r AS (SELECT row_number() OVER (ORDER BY similarity DESC, vec_id) n, * FROM top)
SELECT string_agg(format('[CHUNK {{}}] doc=f{{}} pages={{}}-{{}} section=— chunk_id={{}}' || chr(10) || 'text {{}}' || chr(10), n, label, label, label + 1, vec_id, vec_id), chr(10) || '---' || chr(10) ORDER BY n) context FROM r""")
def rag_context(spark, sf_dir):
    label, key = F.col("label").cast("string"), F.col("vec_id").cast("string")
    rows = _top(spark, sf_dir).select("similarity", F.concat(F.lit("f"), label).alias("file_name"), F.col("label").alias("page_start"), (F.col("label") + 1).alias("page_end"), F.lit(None).cast("string").alias("section_title"), key.alias("chunk_id"), F.concat(F.lit("text "), key).alias("text"), F.lit(None).cast("array<string>").alias("content_types"), F.lit(None).cast("string").alias("file_path"), "vec_id")
    ranked = retrieval.with_defaults(rows).withColumn("rank", F.row_number().over(Window.orderBy(F.desc("similarity"), "vec_id")))  # eight rows
    return retrieval.context(ranked, "rank")


@query("""WITH t AS (SELECT source, doc_id, greatest(1, length(text) // 4) tokens, row_number() OVER (PARTITION BY source ORDER BY doc_id) n FROM documents),
f AS (SELECT source, doc_id, tokens, n, CAST(0 AS BIGINT) batch, 1 size, tokens total FROM t WHERE n = 1 UNION ALL
  SELECT t.source, t.doc_id, t.tokens, t.n, f.batch + CASE WHEN f.size = 16 OR f.total + t.tokens > 6000 THEN 1 ELSE 0 END, CASE WHEN f.size = 16 OR f.total + t.tokens > 6000 THEN 1 ELSE f.size + 1 END, CASE WHEN f.size = 16 OR f.total + t.tokens > 6000 THEN t.tokens ELSE f.total + t.tokens END FROM f JOIN t ON t.source = f.source AND t.n = f.n + 1)
SELECT CAST(substr(source, 4) AS BIGINT) source, doc_id, batch FROM f""".replace("WITH t", "WITH RECURSIVE t"))
def greedy_batches(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.substring("source", 4, 9).cast("long").alias("source"), "doc_id", batching.total_tokens(F.col("text")).alias("tokens"))
    return batching.greedy_batches(rows, "source", "doc_id", "tokens", 16, 6000)


#: The k most similar rows for every row whose id is divisible by 50, among rows of other labels than 5, ties by id.
NEAREST = f"""WITH {CHANGED}, fine AS (SELECT vec_id, label, CAST(v AS DOUBLE[]) v FROM e WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x <> 0)) > 0),
near AS (SELECT a.vec_id query_id, b.vec_id, round(list_cosine_similarity(a.v, b.v), 6) similarity FROM fine a JOIN fine b ON b.label <> 5 WHERE a.vec_id % 50 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS INTEGER) AS rank FROM near)"""


def _indexed(spark, sf_dir):
    """The rows, a search of their index for the queries, and the number of lists that these need."""
    rows = _vectors(spark, sf_dir)
    index = vector_index.build(rows, "vec_id", "v", keep=("label",))
    asked = rows.where(F.pmod("vec_id", F.lit(50)) == 0).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    given = (index, rows, "v", asked, "query_id", "q", 8, F.col("label") != 5)
    return rows, lambda **o: vector_index.search(*given, decimals=6, **o), lambda: vector_index.probes_for(*given)


@query(f"{NEAREST} SELECT query_id, vec_id, similarity, rank FROM ranked WHERE rank <= 8")
def vector_index_exact(spark, sf_dir):
    """An index search that proves that nothing is missing."""
    _, search, _ = _indexed(spark, sf_dir)
    return search(exact=True)


@query(f"{NEAREST} SELECT count(DISTINCT query_id) n_queries, count(*) n_found, TRUE recall_is_enough FROM ranked WHERE rank <= 8")
def vector_index_recall(spark, sf_dir):
    """The approximate search, with its recall against the exact one (0.9 is enough)."""
    _, search, tuned = _indexed(spark, sf_dir)
    found, truth = search(probes=tuned()), search(exact=True)
    both = truth.select("query_id", "vec_id").join(found.select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left")
    counts = found.agg(F.countDistinct("query_id").alias("n_queries"), F.count(F.lit(1)).alias("n_found"))
    return counts.crossJoin(both.agg((F.count("hit") >= 0.9 * F.count(F.lit(1))).alias("recall_is_enough")))  # one row each
