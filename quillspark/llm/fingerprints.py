"""Document fingerprints by consistent weighted sampling.

A document is its distinct words, weighted by their counts. For each of the
fingerprint's places, every word has three numbers that depend on nothing but
the word and the place: r and c from Gamma(2, 1) and b uniform in [0, 1). A
word of weight w is sampled at the step t = floor(ln w / r + b) and has the
value ln a = ln c - r (t - b) - r; the place keeps the least value. Two
documents agree in a place with the probability of their generalised Jaccard
similarity, the sum of the lesser weights over the sum of the greater ones.

Values are computed once for each distinct word and weight of a slice. As a
value stands for one word and step, it is the sample, and its hash is what the
fingerprint keeps: 8 hexadecimal digits for each place.

Defined cases: a null text is empty; texts without words have the fingerprint
of zeros, and are alike only among themselves; equal texts have equal
fingerprints; very long texts are read in parts of ``words.PART_BYTES``; other
columns are ignored; an empty table gives an empty result; of rows that share a
doc_id the greater text comes first in descending order; a null id is the least.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import TASK_BYTES, doc_rows, id_ranges, parts_for, slices, with_following, with_id, without_id
from .words import Words, mix

PLACES = 64
_STEP = 0x9E3779B97F4A7C15


def _uniforms(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers in (0, 1), from 32 bits each."""
    scale = 1.0 / (1 << 32)
    return ((x >> np.uint64(32)) + 0.5) * scale, ((x & np.uint64(0xFFFFFFFF)) + 0.5) * scale


def _values(hashes: np.ndarray, weights: np.ndarray, places: int) -> np.ndarray:
    """ln a for each word and place."""
    seed = mix(hashes[:, None] + np.arange(1, places + 1, dtype=np.uint64) * np.uint64(_STEP))
    one, two = _uniforms(seed)
    r = -np.log(one * two)
    one, two = _uniforms(mix(seed + np.uint64(_STEP)))
    ln_c = np.log(-np.log(one * two))
    b, _ = _uniforms(mix(seed - np.uint64(_STEP)))
    step = np.floor(np.log(weights)[:, None] / r + b)
    return ln_c - r * (step - b) - r


def samples(column: pa.Array, places: int = PLACES) -> np.ndarray:
    """The fingerprint of each text, as 32-bit numbers."""
    n = len(column)
    out = np.zeros((n, places), np.uint32)
    words = Words(column)
    if not len(words):
        return out
    distinct = len(words.named())
    hashes = np.zeros(distinct, np.uint64)
    hashes[words.codes] = words.hashes()[0]
    of = np.repeat(np.arange(n), np.diff(words.starts))
    terms, counts = np.unique(of * distinct + words.codes, return_counts=True)
    of, term = terms // distinct, terms % distinct
    kinds, at = np.unique(term << 32 | counts, return_inverse=True)
    held = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    least = np.empty((len(held), places))
    for a in range(0, places, 16):  # bounds the memory of a slice
        part = _values_of(hashes, kinds, places, a, a + 16)
        for lo in range(0, len(held), 256):
            hi = min(lo + 256, len(held))
            begin, end = held[lo], held[hi] if hi < len(held) else len(of)
            least[lo:hi, a : a + 16] = np.minimum.reduceat(part[at[begin:end]], held[lo:hi] - begin, axis=0)
    out[of[held]] = (mix(least.view(np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    return out


def _values_of(hashes: np.ndarray, kinds: np.ndarray, places: int, a: int, b: int) -> np.ndarray:
    """Values of packed (word, count) kinds for the places from a to b."""
    seeds = hashes[kinds >> 32] + np.uint64(a * _STEP & (1 << 64) - 1)
    return _values(seeds, (kinds & 0xFFFFFFFF).astype(np.float64), min(b, places) - a)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal places, row by row."""
    return (a == b).mean(axis=1)


def spelled(prints: np.ndarray) -> list[str]:
    raw = prints.astype(">u4").tobytes().hex()
    width = 8 * prints.shape[1]
    return [raw[i : i + width] for i in range(0, len(raw), width)]


def fingerprints(docs: DataFrame, places: int = PLACES) -> DataFrame:
    """doc_id and fingerprint."""

    def run(batches):
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spelled(samples(batch.column(1), places)))], names=["doc_id", "fingerprint"])

    return doc_rows(docs).mapInArrow(run, "doc_id long, fingerprint string")


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited_likeness(docs: DataFrame, places: int = PLACES) -> DataFrame:
    """Fingerprints of each text and its edited text, and its likeness to that and to the next document.

    The next document is the one with the next smaller doc_id; after the last
    comes the first. The edited text has its last half (rounded down, in code
    points) replaced by as many first code points of the next one. Documents
    are dealt to ranges of ids, and each range also gets the document that
    follows its last one.
    """
    spark = docs.sparkSession
    docs = doc_rows(docs).withColumn("doc_id", with_id(F.col("doc_id")))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    if size is None:
        return spark.createDataFrame([], SCHEMA)
    ranged, parts = id_ranges(docs, parts_for(spark, size, TASK_BYTES / 2))
    # the greatest id of a range follows the least one of the next range, and the greatest of all the least of all
    place = lambda part, guest: F.array(F.struct(part.cast("int").alias("part"), F.lit(guest).alias("guest")))
    none = F.array().cast("array<struct<part:int,guest:boolean>>")
    places_ = F.concat(place(F.col("part"), False), F.when(F.col("following").isNotNull(), place(F.col("following"), True)).otherwise(none))
    dealt = with_following(ranged, parts).select("doc_id", "text", F.inline(places_)).repartitionById(parts, "part").sortWithinPartitions("guest", F.desc("doc_id"), F.desc("text"))

    def run(batches):
        carried = None
        done = False
        for batch in slices(batches):
            if done:
                break
            if carried is not None:
                batch = pa.RecordBatch.from_arrays([pa.concat_arrays([a, b]) for a, b in zip(carried.columns, batch.columns, strict=True)], names=batch.schema.names)
            guests = batch.column(3).to_numpy(zero_copy_only=False)
            n = int((~guests).sum())
            done = n < len(guests)  # the first guest follows the last one; others repeat its id
            if done:
                batch = batch.slice(0, n + 1)
            if batch.num_rows > 1:
                yield _edited(batch, places)
            carried = batch.slice(batch.num_rows - 1)

    return dealt.mapInArrow(run, SCHEMA).withColumn("doc_id", without_id(F.col("doc_id")))


def _edited(batch: pa.RecordBatch, places: int) -> pa.RecordBatch:
    """Rows of all but the last document, each followed by the next."""
    texts = batch.column(1).to_pylist()
    edited = [a[: len(a) - len(a) // 2] + b[: len(a) // 2] for a, b in zip(texts, texts[1:], strict=False)]
    both = samples(pa.concat_arrays([batch.column(1), pa.array(edited, pa.string())]), places)  # together: they share most words
    prints, of_edited = both[: len(texts)], both[len(texts) :]
    own = prints[:-1]
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0).slice(0, len(edited)),
            pa.array(map(len, texts[:-1]), pa.int64()),
            pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited]),
            pa.array(spelled(own)),
            pa.array(spelled(of_edited)),
            pa.array(likeness(own, of_edited)),
            pa.array(likeness(own, prints[1:])),
        ],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )
