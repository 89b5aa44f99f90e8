"""Language of documents and of the spans within them.

Learning counts byte n-grams (1 to 4 bytes, word ends included) of all labelled
texts for each language, hashed into a fixed number of buckets, and how often
each language uses each script. A word's score under a language is the sum of
its n-grams' log shares. The word's script leaves as candidates the languages
that use it. The best path over a text's words, with a penalty for each change
of language (Viterbi), labels its spans; the language with the most letters is
the document's, and its share of the letters is the score.

The model is small and of a fixed size for each language, so it goes to the
driver and into the tasks; its counts cover every labelled row.

Defined cases: a null text or one without letters (combining marks are none)
is ``und`` with score 0; very long texts are read in parts of
``words.PART_BYTES``, on one path; rows that repeat a document are labelled
each, and each teaches; words without letters belong to the span before them; with nothing learned
every text is ``und``; a script that no language uses leaves the path as it
is; ties go to the language first in order of its name; other columns are
ignored (``filter_rows`` keeps them, whatever their names); an empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .packed import pack, unpack
from .pieces import flat
from .shared import SLICE_BYTES, doc_rows, materialize, slices, tidy
from .words import Words, mix

BUCKET_BITS, LONGEST, SWITCH = 16, 4, 8.0
FAN_IN = 64
#: Languages whose scores are looked up at a time; with more of them, slices of texts are smaller.
FEW = 16
#: A language is a candidate for a script that at least this share of its words has.
USES = 0.005
#: First code points of runs of scripts; fixed values of Unicode's blocks.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "indic"), (0x0E00, "thai"), (0x0E80, "asian"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"),
    (0x3100, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"),
]
_STARTS = np.array([s for s, _ in SCRIPTS])
_NAMES = sorted({n for _, n in SCRIPTS})
_SCRIPT = np.array([_NAMES.index(n) for _, n in SCRIPTS])


class Vocabulary:
    """The distinct words of some texts, in lower case and letters only."""

    def __init__(self, words: Words):
        spelled = pc.replace_substring_regex(pc.utf8_lower(words._dictionary.cast(pa.string())), r"[^\pL\pM]+", "")
        self.data, self.ends = flat(pc.binary_join_element_wise("", spelled, " ", "") if len(spelled) else spelled)
        lengths = np.diff(self.ends)  # with the word's end
        letters = pc.replace_substring_regex(spelled, r"\pM+", "")  # marks alone are no letters
        self.letters = pc.utf8_length(letters).to_numpy(zero_copy_only=False).astype(np.int64) if len(spelled) else np.zeros(0, np.int64)
        self.lengths = lengths

    def scripts(self) -> np.ndarray:
        """The script of each word's first letter."""
        if not len(self.letters):
            return np.zeros(0, np.int64)
        get = lambda i: self.data[np.minimum(self.ends[:-1] + i, len(self.data) - 1)].astype(np.int64)
        a, b, c, d = get(0), get(1) & 63, get(2) & 63, get(3) & 63
        point = np.where(a < 0x80, a, np.where(a < 0xE0, (a & 31) << 6 | b, np.where(a < 0xF0, (a & 15) << 12 | b << 6 | c, (a & 7) << 18 | b << 12 | c << 6 | d)))
        return _SCRIPT[np.searchsorted(_STARTS, point, side="right") - 1]

    def grams(self):
        """For each n: the bucket of every n-gram, and how many each word has, in order."""
        n_bytes = len(self.data)
        code = np.zeros(n_bytes, np.uint64)
        # a word of k bytes has its end at place k, and starts behind an end of its own
        edge = np.full(n_bytes, 32, np.uint64)
        first = np.zeros(n_bytes, bool)
        first[self.ends[:-1][self.lengths > 0]] = True
        place = np.arange(n_bytes) - np.repeat(self.ends[:-1], self.lengths)
        for n in range(1, LONGEST + 1):
            code = code << np.uint64(8) | self.data.astype(np.uint64) if n == 1 else (np.concatenate([edge[:1], code[:-1]]) << np.uint64(8) | self.data)
            code = np.where(first, (np.uint64(32) << np.uint64(8) | self.data) if n > 1 else self.data.astype(np.uint64), code)
            whole = place >= n - 2  # n-grams that lie within the word and its two ends
            counts = np.maximum(self.lengths - max(n - 2, 0), 0)
            yield (mix(code[whole] + np.uint64(n << 56)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), counts


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # buckets, languages
    candidates: np.ndarray  # scripts, languages

    def of_words(self, vocabulary: Vocabulary) -> np.ndarray:
        """Scores of words by language, the best candidate at 0; zero for all without letters."""
        out = np.zeros((len(vocabulary.letters), len(self.languages)))
        for buckets, counts in vocabulary.grams():
            ends = np.cumsum(counts)
            for at in range(0, out.shape[1], FEW):
                sums = np.concatenate([np.zeros((1, out[:1, at : at + FEW].shape[1])), np.cumsum(self.scores[buckets, at : at + FEW], axis=0)])
                out[:, at : at + FEW] += sums[ends] - sums[ends - counts]
        able = self.candidates[vocabulary.scripts()] if len(out) else np.ones(out.shape, bool)
        able |= ~able.any(axis=1, keepdims=True)
        out = np.where(able, out / 2, -1e3)
        out = np.maximum(out - out.max(axis=1, keepdims=True, initial=-1e9), -20.0)
        out[vocabulary.letters == 0] = 0
        return out


def best_path(scores: np.ndarray, codes: np.ndarray, starts: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The language of every word: Viterbi over all texts in step.

    ``scores`` are by distinct word and ``codes`` name each word's. As every
    change costs the same, a state's best predecessor is itself or the best of all.
    """
    lengths = np.diff(starts)
    order = np.argsort(-lengths, kind="stable")
    begin, n = starts[:-1][order], len(order)
    width = scores.shape[1]
    kind = np.min_scalar_type(max(width - 1, 0))
    label = np.zeros(len(codes), kind)
    stays, bests = np.zeros((len(codes), -(-width // 8)), np.uint8), np.zeros(len(codes), kind)  # a bit for each language
    state = np.zeros((n, width))
    longest = int(lengths.max(initial=0))
    active = np.searchsorted(-lengths[order], -np.arange(longest), side="left").tolist()
    rows = np.arange(n)
    for t in range(longest):
        k = active[t]
        own, at = state[:k], begin[:k] + t
        best = own.argmax(axis=1)
        moved = own[rows[:k], best][:, None] - switch
        stays[at], bests[at] = np.packbits(own >= moved, axis=1), best
        state[:k] = np.maximum(own, moved) + scores[codes[at]]
    current = state.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        k = active[t]
        at = begin[:k] + t
        label[at] = current[:k]
        own = current[:k]
        current[:k] = np.where(stays[at, own >> 3] >> (7 - (own & 7)) & 1, own, bests[at])
    return label


def learn(rows: DataFrame) -> Model:
    """Learn from rows of text and lang; those with a null in either are left out."""
    size = 1 << BUCKET_BITS

    @tidy
    def count(batches):
        grams: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            words = Words(batch.column(1))
            if not len(words):
                continue
            langs = batch.column(0).dictionary_encode()
            names = langs.dictionary.to_pylist()
            of = np.repeat(langs.indices.to_numpy(zero_copy_only=False), np.diff(words.starts))
            vocabulary = Vocabulary(words)
            n = len(vocabulary.letters)
            used = np.bincount(of * n + words.codes, minlength=len(names) * n).reshape(len(names), n)
            scripts = vocabulary.scripts()
            for i, name in enumerate(names):
                own = grams.setdefault(name, np.zeros(size + len(_NAMES), np.int64))
                own[size:] += np.bincount(scripts, weights=used[i] * (vocabulary.letters > 0), minlength=len(_NAMES)).astype(np.int64)
                for buckets, counts in vocabulary.grams():
                    weight = np.where(vocabulary.letters > 0, used[i], 0)
                    own[:size] += np.bincount(buckets, weights=np.repeat(weight, counts), minlength=size).astype(np.int64)
        if grams:
            yield pa.RecordBatch.from_arrays([pa.array(list(grams)), pa.array([pack([x], sorted_first=False) for x in grams.values()], pa.binary())], names=["lang", "counts"])

    @tidy
    def merge(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[lang] = total.get(lang, 0) + unpack(data, sorted_first=False)[0]
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array([pack([x], sorted_first=False) for x in total.values()], pa.binary())], names=["lang", "counts"])

    known = rows.where("text is not null and lang is not null").select(F.col("lang").cast("string").alias("lang"), "text")
    schema = "lang string, counts binary"
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    partial = known.mapInArrow(count, schema).repartition(parts, F.monotonically_increasing_id()).mapInArrow(merge, schema)
    # up a tree, so that no task merges more than FAN_IN tables of each language
    while parts > 1:
        partial = materialize(partial.withColumn("to", F.spark_partition_id() % -(-parts // FAN_IN)), "ngrams")
        parts = -(-parts // FAN_IN)
        partial = partial.repartitionById(parts, "to").select("lang", "counts").mapInArrow(merge, schema)
    found = {r["lang"]: unpack(r["counts"], sorted_first=False)[0].astype(np.float64) for r in partial.collect()}
    languages = sorted(found)
    if not languages:
        return Model([], np.zeros((size, 0)), np.zeros((len(_NAMES), 0), bool))
    table = np.stack([found[x] for x in languages], axis=1)
    grams, scripts = table[:size] + 0.5, table[size:]
    scores = np.log(grams / grams.sum(axis=0))
    return Model(languages, scores - scores.mean(axis=1, keepdims=True), scripts >= USES * np.maximum(scripts.sum(axis=0), 1))


def _slice_bytes(model: Model) -> int:
    """Text bytes to work on at a time: scores have a column for each language."""
    return SLICE_BYTES * FEW // max(FEW, len(model.languages))


def label_texts(texts: pa.Array, model: Model) -> tuple[pa.Array, np.ndarray, pa.Array]:
    """The language, the score and the spans of each text."""
    n, width = len(texts), len(model.languages)
    kind = pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32()), ("lang", pa.string())]))
    words = Words(texts)
    if not width or not len(words):
        return pa.array(["und"] * n, pa.string()), np.zeros(n), pa.array([[]] * n, kind)
    names = pa.array(model.languages, pa.string())
    vocabulary = Vocabulary(words)
    label = best_path(model.of_words(vocabulary), words.codes, words.starts).astype(np.int64)
    of = np.repeat(np.arange(n), np.diff(words.starts))
    letters = np.bincount(of * width + label, weights=vocabulary.letters[words.codes], minlength=n * width).reshape(n, width)
    total, best = letters.sum(axis=1), letters.argmax(axis=1)
    score = np.where(total > 0, letters.max(axis=1) / np.maximum(total, 1), 0.0)
    pred = pc.if_else(pa.array(total > 0), names.take(pa.array(best)), pa.scalar("und"))
    starts = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (label[1:] != label[:-1])]))
    span = pa.StructArray.from_arrays([pa.array(starts - words.starts[of[starts]], pa.int32()), pa.array(np.diff(np.append(starts, len(of))), pa.int32()), names.take(pa.array(label[starts]))], names=["first", "words", "lang"])
    return pred, score, pa.ListArray.from_arrays(pa.array(np.searchsorted(of[starts], np.arange(n + 1)), pa.int32()), span)


SCHEMA = "doc_id long, lang_pred string, score double, spans array<struct<first: int, words: int, lang: string>>"


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and spans (first word, number of words, language)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size for each language

    @tidy
    def run(batches):
        for batch in slices(batches, most=_slice_bytes(sent.value)):
            pred, score, spans = label_texts(batch.column(1), sent.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pred, pa.array(score), spans], names=["doc_id", "lang_pred", "score", "spans"])

    return doc_rows(docs).mapInArrow(run, SCHEMA)


def filter_rows(docs: DataFrame, model: Model, least: float = 0.0) -> DataFrame:
    """The rows, with all their columns, that have a language, of at least this share of their letters."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @tidy
    def run(batches):
        for batch in slices(batches, most=_slice_bytes(sent.value)):
            text = batch.column(batch.schema.get_field_index("text"))
            _, score, _ = label_texts(text.fill_null(""), sent.value)
            yield batch.filter(pa.array((score > 0) & (score >= least)))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: Column) -> Column:
    """The rows that are never learned from; a row without an id is none of them, and teaches."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))
