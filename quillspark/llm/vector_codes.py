"""Product codes of vectors, with codebooks fitted in whole numbers.

A vector becomes integers, and its dimensions are cut into equal consecutive
parts. Each place of a part has a codebook, which starts as that part of the
vectors with the least ids and moves for some rounds to the floor of the mean
of the parts that it is nearest to. The code of a vector is the list of its
parts' nearest entries.

In each round a k-d tree of every codebook is sent to the tasks: at most
``parts * entries`` small vectors, whatever the table's size. The search goes
down the near side first, for a whole batch of rows at a time, and then into
every box that is not farther than the best entry found; boxes at an equal
distance are searched too, so the entry with the lower number wins a tie. All
distances and sums are whole numbers, so neither the order of rows nor the
number of tasks changes the result. Tasks return a sum and a count for each
entry, which are grouped in Spark; the driver sees a row for each entry.

Defined cases: rows without a vector, and vectors with null or non-finite
components, are dropped; the table's dimension is that of its least vec_id
whose vector's length is a positive multiple of the parts, and vectors of other
lengths keep their row with a null code and error; rows that repeat an id are
rows of their own (as starting entries they are ordered by id, then vector), a
row without an id is coded but starts no entry; fewer rows than entries give
smaller codebooks; equal entries stay, the first one is used; integers beyond
``LIMIT`` are held at it, so that all sums are exact; a label's error is null
if it exceeds 64 bits; null labels are one label; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import join_hot, materialize, tidy

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Largest size of an integer component: up to 8192 dimensions a squared distance fits into 64 bits.
LIMIT = 1 << 24
LEAF = 8


class Tree:
    """A k-d tree of a codebook: boxes around entries, split at the median of the widest dimension."""

    def __init__(self, entries: np.ndarray, numbers: np.ndarray | None = None):
        self.numbers = np.arange(len(entries)) if numbers is None else numbers
        self.low, self.high = entries.min(axis=0), entries.max(axis=0)
        self.entries, self.sides = entries, None
        if len(entries) > LEAF and (self.high > self.low).any():
            dim = int(np.argmax(self.high - self.low))
            cut = np.sort(entries[:, dim])[(len(entries) - 1) // 2]
            if cut == self.high[dim]:  # most entries are alike there
                cut = entries[:, dim][entries[:, dim] < cut].max()
            left = entries[:, dim] <= cut
            self.dim, self.cut = dim, cut
            self.sides = Tree(entries[left], self.numbers[left]), Tree(entries[~left], self.numbers[~left])

    def bound(self, x: np.ndarray) -> np.ndarray:
        """Squared distance to the box."""
        off = np.maximum(np.maximum(self.low - x, x - self.high), 0)
        return (off * off).sum(axis=1)

    def search(self, x: np.ndarray, rows: np.ndarray, best: np.ndarray, found: np.ndarray) -> None:
        """Lower best and found (an entry's number) of some rows of x."""
        if not len(rows):
            return
        if self.sides is None:
            off = x[rows][:, None, :] - self.entries[None, :, :]
            far = (off * off).sum(axis=2)
            at = far.argmin(axis=1)  # the first of equal ones; numbers ascend in a leaf
            distance, number = far[np.arange(len(rows)), at], self.numbers[at]
            better = (distance < best[rows]) | ((distance == best[rows]) & (number < found[rows]))
            best[rows[better]], found[rows[better]] = distance[better], number[better]
            return
        left, right = self.sides
        on_left = x[rows, self.dim] <= self.cut
        near, rest = rows[on_left], rows[~on_left]
        left.search(x, near, best, found)
        right.search(x, np.concatenate([rest, near[right.bound(x[near]) <= best[near]]]), best, found)
        left.search(x, rest[left.bound(x[rest]) <= best[rest]], best, found)


def nearest(tree: Tree, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each row's nearest entry, the lower one of equals, and its squared distance."""
    best, found = np.full(len(x), np.iinfo(np.int64).max), np.full(len(x), len(tree.numbers))
    tree.search(x, np.arange(len(x)), best, found)
    return found, best


def _matrix(column: pa.Array, parts: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), parts, -1)


def whole_numbers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label and q (floor(scale * x)) of the rows whose vector has finite components only."""
    x = F.col("v")
    fine = x.isNotNull() & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    held = lambda e: F.floor(F.greatest(F.lit(float(-LIMIT)), F.least(F.lit(float(LIMIT)), e * scale))).cast("int")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("v"))
    return rows.where(F.coalesce(fine, F.lit(False))).select("vec_id", "label", F.transform(x, held).alias("q"))


def first_books(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray | None:
    """(parts, entries, length): the parts of the vectors with the least ids; None if there are none."""
    usable = rows.where(F.col("vec_id").isNotNull() & (F.size("q") > 0) & (F.size("q") % parts == 0))
    least = usable.orderBy("vec_id", "q").select(F.size("q").alias("n")).first()
    if least is None:
        return None
    found = usable.where(F.size("q") == least["n"]).orderBy("vec_id", "q").select("q").limit(entries).collect()
    return np.array([r["q"] for r in found], np.int64).reshape(len(found), parts, -1).transpose(1, 0, 2)


def moved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round over all rows of q."""
    parts, entries, length = books.shape
    trees = rows.sparkSession.sparkContext.broadcast([Tree(b) for b in books])

    @tidy
    def run(batches):
        sums, counts = np.zeros((parts, entries, length), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(0), parts)
            for p, tree in enumerate(trees.value):
                found, _ = nearest(tree, x[:, p])
                counts[p] += np.bincount(found, minlength=entries)
                for d in range(length):  # a batch's sums are below 2**53
                    sums[p, :, d] += np.bincount(found, weights=x[:, p, d], minlength=entries).astype(np.int64)
        p, e = np.nonzero(counts)
        each = [np.repeat(p, length), np.repeat(e, length), np.tile(np.arange(length), len(p)), sums[p, e].reshape(-1), np.repeat(counts[p, e], length)]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in each], names=["p", "e", "d", "s", "n"])

    partial = rows.select("q").mapInArrow(run, "p long, e long, d long, s long, n long")
    out = books.copy()
    for r in partial.groupBy("p", "e", "d").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect():
        out[r["p"], r["e"], r["d"]] = r["s"] // r["n"]
    trees.unpersist()
    return out


def coded(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error of all rows."""
    trees, parts, length = rows.sparkSession.sparkContext.broadcast([Tree(b) for b in books]), books.shape[0], books.shape[2]

    @tidy
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(2), parts)
            codes, error = np.zeros((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
            for p, tree in enumerate(trees.value):
                found, distance = nearest(tree, x[:, p])
                codes[:, p] = found
                error += distance
            digits = codes.tobytes().hex()
            code = pa.array([digits[i : i + 2 * parts] for i in range(0, len(digits), 2 * parts)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), code, pa.array(error)], names=["vec_id", "label", "code", "error"])

    fits = F.size("q") == parts * length
    schema = rows.select("vec_id", "label").schema.add("code", "string").add("error", "long")
    rest = rows.where(~fits).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    return rows.where(fits).mapInArrow(run, schema).unionAll(rest)


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and place, as decimals with commas."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray | None]:
    """The codes (vec_id, label, code, error) of vec_id, label and embedding, and the codebooks."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: from 1 to 256 entries")
    rows = materialize(whole_numbers(vectors, scale), "whole-numbers")
    books = first_books(rows, parts, entries)
    if books is None:
        return rows.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")), None
    fitting = rows.where(F.size("q") == books.shape[0] * books.shape[2])
    for _ in range(rounds):
        books = moved(fitting, books)
    return coded(rows, books), books


def with_label_error(codes: DataFrame) -> DataFrame:
    """Adds label_error, the sum of error over equal labels (nulls together)."""
    codes = materialize(codes.withColumn("_named", F.col("label").isNotNull()).withColumn("_label", F.coalesce(F.col("label").cast("string"), F.lit(""))), "codes")
    totals = codes.groupBy("_named", "_label").agg(F.try_sum("error").alias("label_error"), F.count(F.lit(1)).alias("_n"))
    return join_hot(codes, totals, ["_named", "_label"], "vec_id", "_n").drop("_named", "_label", "_n")


def decode(codes: DataFrame, books: np.ndarray, scale: int = SCALE) -> DataFrame:
    """vec_id and embedding: the vectors that codes stand for, at the middle of each integer's range."""
    table = F.array(*(F.array(*(F.array(*(F.lit((int(x) + 0.5) / scale) for x in e)) for e in b)) for b in books))
    entry = lambda p: F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int")
    parts = [F.get(F.get(table, F.lit(p)), entry(p)) for p in range(len(books))]
    return codes.where("code is not null").select("vec_id", F.flatten(F.array(*parts)).alias("embedding"))
