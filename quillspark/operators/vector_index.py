"""Search by an index: lists around coarse centroids, with residual codes of a byte a dimension.

Centroids come from Spark's own k-means over a bounded sample (``SAMPLE``
rows by a hash of the key); every row is then put into the list of its nearest
centroid, with the difference from it coded in bytes and the length of what
the code leaves out. A search is for a whole table of queries: each query
names the lists whose centroids are nearest, queries and lists meet in blocks of
bounded size by a cogroup, a block returns each query's best rows by their
codes, and these are ranked again by their exact cosines. Conditions on rows
hold before anything is ranked; a query that then finds fewer than k rows goes
on through all lists.

An exact search adds a second round: the k-th similarity found so far is a
bound, a list is left out only if its radius proves that none of its rows can
exceed it, a row only if its code and what that leaves out prove the same.
``probes_for`` tells how many lists an approximate search needs on given data.

Ties go to the lower key. Rows of equal vectors beyond the first k by key
cannot be among the k best, so a block leaves them out, however many copies
there are. Vectors that are null, zero, not finite or of another length than
the most frequent one are neither found nor asked for; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.vectors import cosine_similarity, is_valid
from ..sources.store import shared_folder, stored

#: Rows that centroids are fitted on, and the most lists: centroids are on the driver and go to every task.
SAMPLE, MOST_LISTS = 50_000, 4096
#: Rows of a list, and queries, that meet in one task.
BLOCK, QUERY_BLOCK = 16_384, 2048
#: Lists that a query looks into, and how many rows for each wanted one are ranked by exact cosines.
PROBES, RERANK = 16, 4
#: Queries that the number of lists is tuned by, and the share of their neighbours that it is to reach.
TRIED, TARGET = 256, 0.96
#: Rounding of single-precision products that bounds allow for.
SLACK = 1e-5


@dataclass(frozen=True)
class Index:
    """``rows`` has the key, the kept columns, list, part, code, scale, missing and twin; ``sizes`` are rows a list."""

    rows: DataFrame
    key: str
    centroids: np.ndarray
    radius: np.ndarray
    sizes: np.ndarray

    def parts(self) -> np.ndarray:
        return np.maximum(1, -(-self.sizes // BLOCK))

    def save(self, path: str) -> None:
        spark = self.rows.sparkSession
        self.rows.write.parquet(f"{path}/rows")
        lists = [(i, c.tolist(), float(r), int(n)) for i, (c, r, n) in enumerate(zip(self.centroids, self.radius, self.sizes, strict=True))]
        spark.createDataFrame(lists, "list int, centroid array<double>, radius double, n long").coalesce(1).write.parquet(f"{path}/lists")


def load(spark: SparkSession, path: str, key: str) -> Index:
    lists = spark.read.parquet(f"{path}/lists").orderBy("list").collect()  # at most MOST_LISTS
    return Index(spark.read.parquet(f"{path}/rows"), key, np.array([r["centroid"] for r in lists]).reshape(len(lists), -1), np.array([r["radius"] for r in lists]), np.array([r["n"] for r in lists], np.int64))


def _matrix(column: pa.Array) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _scaled(vector: str) -> Column:
    """The vector over its largest component: squares of very large or small ones would not hold."""
    v = F.col(vector).cast("array<double>")
    largest = F.array_max(F.transform(v, F.abs))
    return F.transform(v, lambda x: x / largest)


def _usable(vectors: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """Rows with a vector of the most frequent length that has a direction, and that length (0: no rows)."""
    n = F.size(vector).alias("n")
    most = vectors.where(F.col(vector).isNotNull()).groupBy(n).count().orderBy(F.desc("count"), "n").first()
    dims = most["n"] if most else 0
    return vectors.where(is_valid(vector, dims)), dims


def _fit(usable: DataFrame, key: str, vector: str, lists: int) -> np.ndarray:
    count = usable.count()
    share = min(1.0, SAMPLE / max(1, count))
    sample = usable.where(F.pmod(F.xxhash64(key), F.lit(1 << 20)) < int(share * (1 << 20)))
    lists = lists or int(min(MOST_LISTS, max(1, np.ceil(np.sqrt(count)))))
    rows = sample.select(array_to_vector(_scaled(vector)).alias("features"))
    found = KMeans(k=lists, distanceMeasure="cosine", initMode="random", seed=1, maxIter=10).fit(rows).clusterCenters() if lists > 1 and count > 1 else [np.array(r[0], float) for r in usable.orderBy(key).select(vector).limit(1).collect()]
    centroids = np.array(found)
    norms = np.linalg.norm(centroids, axis=1, keepdims=True)
    return (centroids / np.where(norms > 0, norms, 1)).astype(np.float64)


def build(vectors: DataFrame, key: str, vector: str, lists: int = 0, keep: tuple[str, ...] = ()) -> Index:
    """The index of a table; ``keep`` names columns that conditions of a search may ask for."""
    usable, dims = _usable(vectors, vector)
    usable = usable.where(F.col(key).isNotNull()).select(key, *keep, vector)
    if not dims or usable.isEmpty():
        return Index(usable.select(key, *keep, F.lit(0).alias("list"), F.lit(0).alias("part"), F.lit(None).cast("binary").alias("code"), F.lit(0.0).alias("scale"), F.lit(0.0).alias("missing"), F.lit(0).cast("long").alias("twin")).limit(0), key, np.zeros((0, dims)), np.zeros(0), np.zeros(0, np.int64))
    centroids = _fit(usable, key, vector, lists)
    sent = usable.sparkSession.sparkContext.broadcast(centroids)  # at most MOST_LISTS rows

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(batch.num_columns - 2))
            near = x @ sent.value.T
            at = near.argmax(axis=1)
            rest = x - sent.value[at]
            scale = np.maximum(np.abs(rest).max(axis=1), 1e-30) / 127
            code = np.rint(rest / scale[:, None]).astype(np.int8)
            missing = np.linalg.norm(rest - code * scale[:, None], axis=1)
            angle = np.arccos(np.clip(near[np.arange(len(x)), at], -1, 1))
            codes = pa.array([c.tobytes() for c in code], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], batch.column(batch.num_columns - 1), pa.array(at.astype(np.int32)), codes, pa.array(scale), pa.array(missing), pa.array(angle)], names=[*batch.schema.names[:-2], "twin", "list", "code", "scale", "missing", "angle"])

    kept = usable.select(key, *keep, F.col(vector).cast("array<double>").alias("_v"), F.xxhash64(vector).alias("twin"))
    schema = kept.drop("_v").schema.add("list", "integer").add("code", "binary").add("scale", "double").add("missing", "double").add("angle", "double")
    rows = stored(kept.mapInArrow(assign, schema), "index-rows")
    sizes, radius = np.zeros(len(centroids), np.int64), np.zeros(len(centroids))
    for r in rows.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("angle")).collect():
        sizes[r["list"]], radius[r["list"]] = r["n"], r["angle"]
    index = Index(rows, key, centroids, radius, sizes)
    part = F.pmod(F.xxhash64(key), F.get(F.array(*(F.lit(int(p)) for p in index.parts())), F.col("list"))).cast("int")
    # files hold runs of lists, so a search of some lists reads only these
    dealt = rows.withColumn("part", part).drop("angle").repartitionByRange("list", "part").sortWithinPartitions("list", "part")
    return replace(index, rows=stored(dealt, "index"))


def _asked(queries: DataFrame, index: Index, probes: int) -> DataFrame:
    """A row for each query and list that it looks into: of ``least`` (a similarity, or null) and _q;
    without least the nearest ``probes`` lists, with it all that may hold a row as similar."""
    sent = queries.sparkSession.sparkContext.broadcast((index.centroids, index.radius, index.sizes > 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, radius, held = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            near = _matrix(batch.column(2)) @ centroids.T
            near[:, ~held] = -np.inf
            least = batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
            able = np.cos(np.maximum(0, np.arccos(np.clip(near, -1, 1)) - radius)) + SLACK >= least[:, None]
            order = np.argsort(-near, axis=1, kind="stable")[:, :probes]
            first = np.zeros(near.shape, bool)
            np.put_along_axis(first, order, True, axis=1)
            row, at = np.nonzero(np.where(np.isnan(least)[:, None], first, able) & held)
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(row)) for c in batch.columns), pa.array(at.astype(np.int32))], names=["_query", "least", "_q", "list"])

    return queries.select("_query", "least", "_q").mapInArrow(run, queries.select("_query", "least", "_q").schema.add("list", "integer"))


def _scan(index: Index, rows: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """_query and the key of rows that may be among its k best, by their codes."""
    parts = F.get(F.array(*(F.lit(int(p)) for p in index.parts())), F.col("list"))
    per_list = {r["list"]: r["n"] for r in asked.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most MOST_LISTS rows
    blocks = F.get(F.array(*(F.lit(-(-per_list.get(i, 0) // QUERY_BLOCK)) for i in range(len(index.sizes)))), F.col("list"))
    left = asked.withColumn("block", F.pmod(F.xxhash64("_query"), blocks).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    wanted = rows.where(blocks > 0).select(F.col(index.key).alias("_key"), "list", "part", "code", "scale", "missing", "twin")
    right = wanted.withColumn("block", F.explode(F.sequence(F.lit(0), blocks.cast("int") - 1)))
    centroids = asked.sparkSession.sparkContext.broadcast(index.centroids)
    best = k * RERANK

    def meet(asked_: pa.Table, held: pa.Table) -> pa.Table:
        nothing = pa.table({"_query": asked_["_query"].slice(0, 0), "_key": held["_key"].slice(0, 0), "near": pa.array([], pa.float64())})
        if not asked_.num_rows or not held.num_rows:
            return nothing
        held = held.take(pc.sort_indices(held, [("twin", "ascending"), ("_key", "ascending")]))
        twin = held["twin"].to_numpy()
        run = np.flatnonzero(np.concatenate([[True], twin[1:] != twin[:-1]]))
        place = np.arange(len(twin)) - np.repeat(run, np.diff(np.append(run, len(twin))))
        held = held.take(pa.array(np.flatnonzero(place < k))).combine_chunks()
        c = centroids.value[asked_["list"][0].as_py()]
        codes = np.frombuffer(b"".join(held["code"].to_pylist()), np.int8).reshape(held.num_rows, -1).astype(np.float32)
        q = _matrix(asked_["_q"].combine_chunks())
        near = (q.astype(np.float32) @ codes.T) * held["scale"].to_numpy().astype(np.float32) + (q @ c)[:, None]
        least = asked_["least"].to_numpy(zero_copy_only=False).astype(np.float64)
        if near.shape[1] > best:
            edge = np.partition(near, near.shape[1] - best, axis=1)[:, near.shape[1] - best]
        else:
            edge = np.full(len(near), -np.inf)
        able = np.where(np.isnan(least)[:, None], near >= edge[:, None], near + held["missing"].to_numpy()[None, :] + SLACK >= least[:, None])
        i, j = np.nonzero(able)
        return pa.table({"_query": asked_["_query"].take(pa.array(i)), "_key": held["_key"].take(pa.array(j)), "near": near[i, j].astype(np.float64)})

    by = ["list", "part", "block"]
    schema = asked.select("_query").schema.add("_key", rows.schema[index.key].dataType).add("near", "double")
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(meet, schema)


def _ranked(found: DataFrame, asked: DataFrame, source: DataFrame, key: str, vector: str, k: int, decimals: int | None) -> DataFrame:
    exact = found.join(source.select(F.col(key).alias("_key"), F.col(vector).alias("_x")), "_key").join(asked.select("_query", "_q"), "_query")
    similarity = cosine_similarity(_scaled("_x"), _scaled("_q"))
    rows = exact.select("_query", "_key", similarity.alias("exact"), (F.round(similarity, decimals) if decimals else similarity).alias("similarity"))
    rank = F.row_number().over(Window.partitionBy("_query").orderBy(F.desc("similarity"), "_key"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k)


def search(index: Index, source: DataFrame, vector: str, queries: DataFrame, query_key: str, query_vector: str, k: int = 8, where: Column | None = None, probes: int = PROBES, exact: bool = False, decimals: int | None = None) -> DataFrame:
    """query_key, the index's key, similarity and rank (from 1) of each query's k most similar rows.

    ``source`` has the indexed vectors by key, for the exact cosines; ``where``
    is a condition on the index's kept columns. With ``decimals`` similarities
    are rounded before they are ranked.
    """
    spark, dims = queries.sparkSession, index.centroids.shape[1]
    out = lambda df: df.select(F.col("_query").alias(query_key), F.col("_key").alias(index.key), "similarity", "rank")
    asked = queries.where(is_valid(query_vector, dims)).select(F.col(query_key).alias("_query"), F.col(query_vector).cast("array<double>").alias("_q"), F.lit(None).cast("double").alias("least"))
    asked = stored(asked, "queries")
    if not len(index.centroids):
        return out(spark.createDataFrame([], asked.select("_query").schema.add("_key", index.rows.schema[index.key].dataType).add("similarity", "double").add("rank", "integer")))
    rows = index.rows if where is None else index.rows.where(where)
    near = _scan(index, rows, _asked(asked, index, probes), k)
    order = F.row_number().over(Window.partitionBy("_query").orderBy(F.desc("near"), "_key"))
    first = near.withColumn("n", order).where(F.col("n") <= k * RERANK).select("_query", "_key")
    found = stored(_ranked(first, asked, source, index.key, vector, k, decimals), "found")
    # whoever has less than k rows looks into all lists; an exact search looks wherever there may be more
    bounds = found.groupBy("_query").agg(F.count(F.lit(1)).alias("n"), F.min("exact").alias("worst"))
    short = asked.drop("least").join(bounds, "_query", "left").withColumn("few", F.coalesce("n", F.lit(0)) < k)
    margin = 10.0 ** -(decimals or 12)
    again = short.where(F.col("few") | F.lit(exact)).select("_query", "_q", F.when(F.col("few"), F.lit(-2.0)).otherwise(F.col("worst") - margin).alias("least"))
    again = stored(again, "asked-again")
    if again.isEmpty():
        return out(found)
    more = _scan(index, rows, _asked(again, index, probes), k).select("_query", "_key").distinct()
    rest = found.join(again.select("_query"), "_query", "left_anti")
    return out(rest.unionByName(_ranked(more, again, source, index.key, vector, k, decimals)))


def probes_for(index: Index, source: DataFrame, vector: str, queries: DataFrame, query_key: str, query_vector: str, k: int = 8, where: Column | None = None, target: float = TARGET) -> int:
    """How many lists a query must look into so that this share of the true neighbours lies in them,
    by an exact search for at most ``TRIED`` of the queries (by a hash of their key)."""
    tried = queries.where(is_valid(query_vector, index.centroids.shape[1])).orderBy(F.xxhash64(query_key), query_key).limit(TRIED).select(F.col(query_key).alias("_query"), F.col(query_vector).cast("array<double>").alias("_q"))
    tried = stored(tried, "tried")
    truth = search(index, source, vector, tried, "_query", "_q", k, where, exact=True)
    pairs = truth.select("_query", F.col(index.key).alias("_key")).join(index.rows.select(F.col(index.key).alias("_key"), "list"), "_key").groupBy("_query").agg(F.collect_list("list").alias("lists"))
    rows = pairs.join(tried, "_query").select("_q", "lists").collect()  # at most TRIED, of k lists each
    if not rows:
        return PROBES
    x = _matrix(pa.array([r["_q"] for r in rows], pa.list_(pa.float64())))
    near = x @ index.centroids.T
    near[:, index.sizes == 0] = -np.inf
    place = np.argsort(np.argsort(-near, axis=1, kind="stable"), axis=1)
    found = np.sort(np.concatenate([place[i, r["lists"]] for i, r in enumerate(rows)]))
    return int(found[min(len(found) - 1, int(np.ceil(target * len(found))))]) + 1


def recall(found: DataFrame, truth: DataFrame, query_key: str, key: str) -> float:
    """The share of the true pairs of query and key that were found."""
    both = truth.select(query_key, key).join(found.select(query_key, key, F.lit(1).alias("hit")), [query_key, key], "left")
    got = both.agg(F.count("hit").alias("hit"), F.count(F.lit(1)).alias("n")).first()
    return got["hit"] / got["n"] if got["n"] else 1.0


def refreshed(spark: SparkSession, index: Index, name: str = "index") -> str:
    """Save the index to a fresh folder of the shared storage and return it: readers switch when they are told."""
    path = shared_folder(spark, name)
    index.save(path)
    return path
