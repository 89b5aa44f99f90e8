"""Near-duplicate vectors within a label, by spherical-cap filters.

Filters are unit directions of a structured random product code: the
dimensions are dealt to blocks (after a random rotation by signs and a
permutation), each block has its own codebook of random directions, and every
choice of one code per block is a filter. So a few thousand codes span
millions of filters, and a vector is decoded to the list of all filters that
it exceeds a threshold with by combining block scores, best first, under a
bound on what the blocks to come can add. The number of filters follows the
number of vectors, so that a vector shares filters with some few unrelated ones
only. A vector that
exceeds too few filters lowers its own threshold until it has enough. Both
numbers grow with the logarithm of the vectors, which keeps the share of near
pairs without a common filter level.

Vectors that share a filter are candidates if their signs along random
directions agree, too: of ``SIGNS`` signs a pair at the threshold has at most
``signs_apart`` different ones (but for one pair in a thousand million), which
unrelated vectors, or those with a common offset, do not come near. So what chains
into a group are close vectors, not all that meet in some filter. Within a
group cosines are computed in double precision, in blocks of
bounded size (``graph.links_within``): each vector gets a count of its links,
and links between what is not joined yet are returned, never pairs.

Defined cases: null labels, null or zero vectors and vectors with null or
non-finite components have no links; vectors of different lengths are not
compared; equal vectors collapse to one with a multiplicity beforehand; rows
that repeat an id are vectors of their own, one row each in the result, and
count as links of each other if they are near; a null id stays a row, and its
component is the least other id or null; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from functools import cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import candidate_groups, components, links_within
from .shared import join_hot, materialize, parts_for

SIMILAR = 0.98
#: Filters that a vector exceeds on average and at the least among SMALL vectors of a label, and more of
#: both for each doubling: as filters grow in number, two near vectors share fewer of them.
LISTED, LEAST, SMALL, MORE = 24, 14, 5000, (5, 4)
BLOCK = 1024
#: Filters for each one that a vector of the largest label lists: unrelated vectors then share one with few others.
FILTERS_PER_LISTED = 32
#: Signs that a vector is sketched by, and standard deviations of their number that a near pair may be off.
SIGNS, DEVIATIONS = 256, 7
#: Rows that one task decodes.
TASK_ROWS = 50_000


@cache
def code(dim: int, blocks: int, size: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The rotation and the codebooks; the same in every process."""
    rng = np.random.default_rng([dim, blocks, size])
    order = rng.permutation(dim)
    books = []
    for part in np.array_split(order, blocks):
        book = rng.standard_normal((size, len(part)))
        book /= np.linalg.norm(book, axis=1, keepdims=True) * np.sqrt(blocks)
        books.append(book)
    return order, books


def listing(vectors: int) -> tuple[int, int]:
    """Filters that a vector exceeds on average and at the least, for so many vectors with one label at most."""
    doublings = max(0.0, float(np.log2(max(1, vectors) / SMALL)))
    return int(LISTED + MORE[0] * doublings), int(LEAST + MORE[1] * doublings)


def shape(vectors: int, dim: int) -> tuple[int, int]:
    """Blocks and codes a block, for so many vectors with one label at most."""
    wanted = max(1 << 16, vectors * FILTERS_PER_LISTED * listing(vectors)[0])
    blocks = min(2, dim)
    while blocks < dim and wanted ** (1 / blocks) > 4096:
        blocks += 1
    return blocks, max(2, int(np.ceil(wanted ** (1 / blocks))))


def decode(scores: list[np.ndarray], threshold: float) -> np.ndarray:
    """Numbers of all filters whose block scores sum to the threshold or more."""
    best = np.array([s.max() for s in scores])
    rest = np.append(np.cumsum(best[::-1])[::-1][1:], 0.0)
    sums, numbers = np.zeros(1), np.zeros(1, np.int64)
    for s, after in zip(scores, rest, strict=True):
        able = np.flatnonzero(s >= threshold - after - sums.max(initial=-np.inf))
        total = sums[:, None] + s[able]
        keep = total >= threshold - after
        sums, numbers = total[keep], (numbers[:, None] * len(s) + able)[keep]
    return numbers


def filters_of(x: np.ndarray, blocks: int, size: int, listed: int = LISTED, least: int = LEAST) -> list[np.ndarray]:
    """The filters that each unit vector exceeds: ``listed`` on average, ``least`` at the least."""
    dim = x.shape[1]
    order, books = code(dim, blocks, size)
    parts = np.array_split(x[:, order], np.cumsum([b.shape[1] for b in books])[:-1], axis=1)
    scores = [p @ b.T for p, b in zip(parts, books, strict=True)]
    filters = float(size) ** blocks
    start = -NormalDist().inv_cdf(min(0.5, listed / filters)) / np.sqrt(dim)
    out = []
    for i in range(len(x)):
        own, threshold = [s[i] for s in scores], start
        found = decode(own, threshold)
        while len(found) < min(least, filters):
            threshold -= 0.1 / np.sqrt(dim)
            found = decode(own, threshold)
        out.append(found)
    return out


@cache
def directions(dim: int) -> np.ndarray:
    return np.random.default_rng([dim, SIGNS]).standard_normal((dim, SIGNS))


def signs(x: np.ndarray) -> np.ndarray:
    """The signs of each vector along random directions, as rows of 64-bit words."""
    return np.packbits(x @ directions(x.shape[1]) > 0, axis=1).view(np.int64)


def signs_apart(similar: float) -> int:
    """Different signs that a pair at this cosine has at most."""
    share = np.arccos(max(-1.0, min(1.0, similar))) / np.pi
    return int(np.ceil(SIGNS * share + DEVIATIONS * np.sqrt(SIGNS * share * (1 - share)))) + 1


def _unit(column) -> np.ndarray:
    x = np.asarray(column.flatten(), np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small components would not hold
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _rows(vectors: DataFrame) -> DataFrame:
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("v"))


def _is_usable() -> Column:
    """Whether a row of _rows may have links."""
    ok = F.col("v").isNotNull() & F.col("label").isNotNull() & F.exists("v", lambda x: x != 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(ok, F.lit(False))


def _usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label, dim and v of the vectors that may have links."""
    return _rows(vectors).where(_is_usable()).withColumn("dim", F.size("v"))


def _listed(heads: DataFrame, blocks: int, size: int, listed: int, least: int) -> DataFrame:
    """node, keys (of label, dimension and filter, for every filter that it exceeds) and sketch (its signs) of every vector."""

    def run(batches):
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims):
                rows = batch.filter(pa.array(dims == dim))
                for start in range(0, rows.num_rows, 512):
                    part = rows.slice(start, 512)
                    x = _unit(part.column(3))
                    found = filters_of(x, min(blocks, int(dim)), size, listed, least)
                    ends = np.concatenate([[0], np.cumsum([len(f) for f in found])])
                    own = signs(x)
                    arrays = [part.column(0), part.column(1), part.column(2), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found))), pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1) * own.shape[1], pa.int32()), pa.array(own.reshape(-1)))]
                    yield pa.RecordBatch.from_arrays(arrays, names=["node", "dim", "label", "filters", "sketch"])

    found = heads.select("node", "dim", "label", "v").mapInArrow(run, "node long, dim int, label string, filters array<long>, sketch array<long>")
    # hashes that coincide bring some more vectors together, none apart
    return found.select("node", F.transform("filters", lambda f: F.xxhash64("label", "dim", f)).alias("keys"), "sketch")


def _read(t: pa.Table) -> np.ndarray:
    return _unit(t["v"].combine_chunks())


def near_vectors(vectors: DataFrame, similar: float = SIMILAR, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of vec_id, embedding and label."""
    spark = vectors.sparkSession
    usable = _usable(vectors)
    # a number for each different vector, as rows may share an id
    heads = usable.groupBy("label", "dim", "v").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies")).withColumn("node", F.monotonically_increasing_id())
    heads = materialize(heads, "vectors")
    most = heads.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.max("dim")).first()
    blocks, size = shape(most[0] or 1, most[1] or 1)
    parts = parts_for(spark, heads.count(), TASK_ROWS)
    listed = materialize(_listed(heads.repartition(parts), blocks, size, *listing(most[0] or 1)), "filters")
    groups = materialize(candidate_groups(listed, signs_apart(similar)), "groups")
    members = heads.join(groups, "node").select("component", "node", (8 * F.col("dim")).cast("long").alias("bytes"), "copies", "v")
    found = materialize(links_within(members, _read, lambda a, b: a @ b.T >= similar, block, count=True), "links")
    joined = components(found.where("b is not null").select("a", "b"))
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    of_node = materialize(heads.select("node", "least").join(joined, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "least"), "classes")
    named = join_hot(of_node, of_node.groupBy("component").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n")), ["component"], "node", "n").select("node", "component_id")
    per_head = heads.select("label", "dim", "v", "node", "copies").join(counts, "node", "left").join(named, "node")
    per_head = per_head.select("label", "dim", "v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id", "copies")
    linked = join_hot(usable, per_head, ["label", "dim", "v"], "vec_id", "copies", small=0).select("vec_id", "n_links", "component_id")
    rest = _rows(vectors).where(~_is_usable()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.unionAll(rest)
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
