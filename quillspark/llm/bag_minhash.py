"""Near-duplicate documents by BagMinHash signatures over word shingles.

A document is the multiset of its runs of five words. Its weight axis is
discretised to whole counts and cut into dyadic levels; each shingle and level
has a Poisson process of points (arrival time, register, place on the weight
axis) that depends on nothing else, with a rate in proportion to the level's
width. A register keeps the earliest point that lies below the shingle's
count. Points come in order of arrival, so a process ends as soon as its next
point is later than the document's latest register. Two documents agree in a
register with the probability of their multiset Jaccard similarity.

Bands of registers give candidates, and every link is verified on the
multisets themselves:

* documents with equal multisets collapse to the first one beforehand, by a
  grouped minimum (so no group of copies, however large, meets in a task),
* documents that share a band are candidates if their registers agree as well: of
  the ``bands * rows`` registers, of which a sketch keeps 4 bits each, a pair
  at the threshold differs in at most ``registers_apart``. So pages that share a
  template, and thus many bands, are not chained into one group
  (``graph.candidate_groups``), unless their similarity comes close to the threshold,
* within a group similarities are computed exactly, of pairs whose sketches
  agree in the same way, in pairs of blocks of bounded size, until all pairs of
  documents that no links join yet have been compared (``graph.links_within``).

With 30 bands of 4 registers a pair at the threshold of 0.8 shares no band with
probability 1.3e-7, and differs in more registers with 1e-6.

Defined cases: a null text or one without words is in a class of its own; a
text of fewer than five words is one shingle, one of any length is compared
whole; repeated rows are copies; rows that share an id but not the text are
classed each by its text; a row without an id is compared with nothing, has no
class and is kept; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import BLOCK, candidate_groups, components, links_within, words_apart
from .packed import pack, unpack
from .shared import doc_rows, join_hot, materialize, slices, tidy
from .words import Words, inside, mix, windows

SHINGLE, BANDS, BAND_ROWS, SIMILAR = 5, 30, 4, 0.8
#: Bits of a register in a sketch, and standard deviations of their differences that a near pair may be off.
SKETCH_BITS, DEVIATIONS = 4, 5
#: Elements that are compared at a time.
COLUMNS = 4096
#: Share of a block's pairs with agreeing sketches from which all of them are compared at once.
DENSE = 0.05
_TAG = 0xD6E8FEB86659FD93


def bags(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: text, hash and count, sorted by text and hash."""
    words = Words(column)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    low, _ = words.hashes()
    at, of = inside(words.starts, size)
    hashes, texts = [windows(low, size)[at] if len(at) else np.zeros(0, np.uint64)], [of]
    lengths = np.diff(words.starts)
    for n in range(1, size):
        short = np.flatnonzero(lengths == n)
        if len(short):
            hashes.append(mix(windows(low, n)[words.starts[:-1][short]] + np.uint64(n * _TAG & (1 << 64) - 1)))
            texts.append(short)
    of, h = np.concatenate(texts), np.concatenate(hashes)
    order = np.lexsort((h, of))
    of, h = of[order], h[order]
    new = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (h[1:] != h[:-1])]))
    return of[new], h[new], np.diff(np.append(new, len(of)))


def _uniform(x: np.ndarray) -> np.ndarray:
    """In (0, 1], from 53 bits."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * (1.0 / (1 << 53))


def signatures(of: np.ndarray, hashes: np.ndarray, counts: np.ndarray, n: int, registers: int) -> np.ndarray:
    """Registers (n, registers) of the multisets; infinite where a text has no shingle."""
    held = np.full(n * registers, np.inf)
    if not len(of):
        return held.reshape(n, registers)
    # a process for each level that the count reaches: level 0 is [0, 1), level j is [2**(j-1), 2**j)
    levels = 1 + np.ceil(np.log2(counts)).astype(np.int64)
    of, seed, limit = np.repeat(of, levels), np.repeat(hashes, levels), np.repeat(counts, levels)
    ends = np.cumsum(levels)
    level = np.arange(len(of)) - np.repeat(ends - levels, levels)
    floor = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    width = np.where(level == 0, 1, floor)
    seed = mix(seed + level.astype(np.uint64) * np.uint64(_TAG))
    time = np.zeros(len(of))
    latest = np.full(n, np.inf)
    step = 0
    while len(of):
        step += 1
        draw = mix(seed + np.uint64(step * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        time = time - np.log(_uniform(draw)) / (width * registers)
        on = time < latest[of]
        of, seed, limit, floor, width, time, draw = (x[on] for x in (of, seed, limit, floor, width, time, draw))
        more = mix(draw + np.uint64(_TAG))
        register = ((more >> np.uint64(32)) % np.uint64(registers)).astype(np.int64)
        place = floor + (((more & np.uint64(0xFFFFFFFF)) * width.astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        below = place < limit
        np.minimum.at(held, of[below] * registers + register[below], time[below])
        latest = held.reshape(n, registers).max(axis=1)
    return held.reshape(n, registers)


def band_keys(held: np.ndarray, bands: int, rows: int) -> np.ndarray:
    bits = held.view(np.uint64).reshape(len(held), bands, rows)
    keys = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(_TAG) + np.zeros((len(held), 1), np.uint64)
    for i in range(rows):
        keys = mix(keys ^ bits[:, :, i]) + np.uint64(i)
    return keys.view(np.int64)


def sketches(held: np.ndarray) -> np.ndarray:
    """Some bits of each register, 16 registers to a 64-bit word."""
    bits = mix(held.view(np.uint64)) & np.uint64((1 << SKETCH_BITS) - 1)
    each = 64 // SKETCH_BITS
    padded = np.zeros((len(bits), -(-bits.shape[1] // each) * each), np.uint64)
    padded[:, : bits.shape[1]] = bits
    shifts = (np.arange(each) * SKETCH_BITS).astype(np.uint64)
    return (padded.reshape(len(bits), -1, each) << shifts).sum(axis=2, dtype=np.uint64).view(np.int64)


def registers_apart(similar: float, registers: int) -> int:
    """Registers of a sketch in which a pair with this similarity differs at most."""
    share = (1 - similar) * (1 - 0.5**SKETCH_BITS)
    return int(np.ceil(registers * share + DEVIATIONS * np.sqrt(registers * share * (1 - share)))) + 1


def sketch(docs: DataFrame, size: int = SHINGLE, bands: int = BANDS, rows: int = BAND_ROWS) -> DataFrame:
    """doc_id, bag (a digest of the multiset; null without words), weight, keys (of its bands) and sketch."""

    @tidy
    def run(batches):
        for batch in slices(batches):
            n = batch.num_rows
            of, h, counts = bags(batch.column(1), size)
            held = signatures(of, h, counts, n, bands * rows)
            keys, bits = band_keys(held, bands, rows), sketches(held)
            digest = _digests(of, h, counts, n)
            weight = np.bincount(of, weights=counts, minlength=n).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digest, pa.binary()), pa.array(weight), _lists(keys), _lists(bits)], names=["doc_id", "bag", "weight", "keys", "sketch"])

    return doc_rows(docs).mapInArrow(run, "doc_id long, bag binary, weight long, keys array<long>, sketch array<long>")


def _lists(rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32()), pa.array(rows.reshape(-1)))


def _digests(of: np.ndarray, h: np.ndarray, counts: np.ndarray, n: int) -> list[bytes | None]:
    """A digest of each text's multiset; none without words."""
    ends = np.searchsorted(of, np.arange(n + 1)).tolist()
    both = np.stack([h, counts.astype(np.uint64)], axis=1) if len(h) else np.zeros((0, 2), np.uint64)
    raw = memoryview(np.ascontiguousarray(both).reshape(-1)).cast("B") if len(h) else b""
    return [hashlib.blake2b(raw[16 * a : 16 * b], digest_size=16).digest() if b > a else None for a, b in zip(ends, ends[1:], strict=False)]


def _multisets(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, bag (its digest) and data (the packed multiset) of doc_id and text."""

    @tidy
    def run(batches):
        for batch in slices(batches):
            of, h, counts = bags(batch.column(1), size)
            ends = np.searchsorted(of, np.arange(batch.num_rows + 1)).tolist()
            data = [pack([h[a:b], counts[a:b]]) for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_digests(of, h, counts, batch.num_rows), pa.binary()), pa.array(data, pa.binary())], names=["doc_id", "bag", "data"])

    return docs.mapInArrow(run, "doc_id long, bag binary, data binary")


def overlaps(a: list[tuple[np.ndarray, np.ndarray]], b: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Multiset Jaccard similarity of each of one list with each of the other.

    The k-th copy of a shingle is an element of its own, so the common weight
    is the number of common elements: a product of 0/1 matrices, some thousand
    elements at a time. Elements that only one side has are left out before.
    """

    def elements(bags_: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        of = np.repeat(np.arange(len(bags_)), [len(h) for h, _ in bags_])
        h, c = (np.concatenate([x[i] for x in bags_]) for i in (0, 1))
        c = c.astype(np.int64)
        copy = np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
        h = np.repeat(h, c)
        return np.repeat(of, c), np.where(copy == 0, h, mix(h + copy.astype(np.uint64) * np.uint64(_TAG)))

    (of_a, h_a), (of_b, h_b) = elements(a), elements(b)
    shared = np.intersect1d(h_a, h_b)
    common = np.zeros((len(a), len(b)), np.float32)
    if len(shared):
        sides = []
        for of, h in ((of_a, h_a), (of_b, h_b)):
            at = np.minimum(np.searchsorted(shared, h), len(shared) - 1)
            on = shared[at] == h
            order = np.argsort(at[on], kind="stable")
            sides.append((at[on][order], of[on][order]))
        for start in range(0, len(shared), COLUMNS):
            width = min(COLUMNS, len(shared) - start)
            parts = []
            for (at, of), n in zip(sides, (len(a), len(b)), strict=True):
                lo, hi = np.searchsorted(at, (start, start + width))
                m = np.zeros((n, width), np.float32)
                m[of[lo:hi], at[lo:hi] - start] = 1
                parts.append(m)
            common += parts[0] @ parts[1].T
    weight_a, weight_b = (np.array([int(c.sum()) for _, c in x], float) for x in (a, b))
    return common / (weight_a[:, None] + weight_b[None, :] - common)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Multiset Jaccard similarity of two sorted multisets."""
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    both = b[0][at] == a[0]
    common = int(np.minimum(a[1][both], b[1][at[both]]).sum())
    return common / (int(a[1].sum()) + int(b[1].sum()) - common)


def near_bags(limit: int, similar: float):
    """Which pairs of two blocks (sketches, multisets) are near: those with agreeing sketches are compared exactly."""
    _, apart = words_apart(SKETCH_BITS)

    def near(a, b) -> np.ndarray:
        hits = apart(a[0], b[0]) <= limit
        if hits.mean() > DENSE:
            i, j = np.flatnonzero(hits.any(axis=1)), np.flatnonzero(hits.any(axis=0))
            hits[np.ix_(i, j)] &= overlaps([a[1][x] for x in i], [b[1][x] for x in j]) >= similar
        else:
            for i, j in np.argwhere(hits):
                hits[i, j] = similarity(a[1][i], b[1][j]) >= similar
        return hits

    return near


def near_duplicates(docs: DataFrame, similar: float = SIMILAR, size: int = SHINGLE, bands: int = BANDS, rows: int = BAND_ROWS, block: int = BLOCK) -> DataFrame:
    """doc_id, class_id (the least doc_id of its class) and kept (whether it is that one)."""
    docs = doc_rows(docs)
    sketched = materialize(sketch(docs.where("doc_id is not null"), size, bands, rows), "sketches")
    # a number for each different multiset, as rows may share an id
    heads = sketched.where("bag is not null").groupBy("bag").agg(F.min("doc_id").alias("doc_id"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch"), F.count(F.lit(1)).alias("copies")).withColumn("node", F.monotonically_increasing_id())
    heads = materialize(heads, "heads")
    limit = registers_apart(similar, bands * rows)
    found = candidate_groups(heads.select("node", "keys", "sketch"), limit, SKETCH_BITS)
    groups = materialize(found.join(heads.select("node", "doc_id", "bag", "sketch"), "node"), "groups")
    multisets = _multisets(docs.join(groups.select("doc_id"), "doc_id", "left_semi"), size)
    members = multisets.join(groups, ["doc_id", "bag"]).select("component", "node", F.octet_length("data").cast("long").alias("bytes"), "sketch", "data")
    if not sketched.groupBy("doc_id").count().where("count > 1").isEmpty():
        members = members.dropDuplicates(["node"])
    links = links_within(members, _read, near_bags(limit, similar), block).select("a", "b")
    # only multisets with links or copies have a class that is not their one row's id
    found = materialize(components(links), "components")
    linked = materialize(heads.select("node", "bag", "doc_id", "copies").join(found, "node"), "linked")
    least = linked.groupBy("component").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n"))
    named = join_hot(linked, least, ["component"], "bag", "n").select("bag", "class_id", "copies")
    copied = heads.where("copies > 1").join(found, "node", "left_anti").select("bag", F.col("doc_id").alias("class_id"), "copies")
    classes = materialize(named.unionAll(copied), "classes")
    every = join_hot(sketched.where("bag is not null").select("doc_id", "bag"), classes, ["bag"], "doc_id", "copies", how="left")
    same = every.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
    alone = sketched.where("bag is null").select("doc_id", F.col("doc_id").alias("class_id")).unionAll(docs.where("doc_id is null").select("doc_id", F.col("doc_id").alias("class_id")))
    return same.unionAll(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))


def _read(t: pa.Table) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    bits = t["sketch"].combine_chunks()
    own = bits.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(bits), -1)
    return own, [tuple(unpack(x)) for x in t["data"].to_pylist()]
