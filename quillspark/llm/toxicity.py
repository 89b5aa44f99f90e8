"""Toxicity of documents: a learned lexicon, misspellings and context.

Learning takes labelled rows: all of them up to ``SAMPLE_ROWS``, beyond that
about so many by a hash of the id (a bound, so that their ids and features may
go to every task and to the driver). Texts that repeat with one label count
once in all that the lexicon is learned from. From them come

* the lexicon: words, and stems that many different words start with, whose
  presence speaks for a toxic document,
* the weights of a logistic model over what the lexicon finds.

Which terms enter is a test at a false discovery rate. A term's evidence is
the Chernoff bound on how likely its toxic share is by chance, in nats; the
least evidence is the smallest value above which the terms that chance could
lift there are at most ``CHANCE`` of those found. Only terms frequent enough
to reach it count as tests, so few labels learn the clear terms and many learn
fainter ones, by one rule and without a cap. An entry must also be ``LIFT``
times as frequent in toxic documents.

Searching intersects a Levenshtein automaton of a word with the lexicon's
trie, so a word matches entries within one edit (two for long entries), and
stems by what it starts with, within one edit for long stems. Each find is
scored in its context window: finds between quotation marks count apart from
bare ones, and finds near each other add up.

Defined cases: a null or empty text has no finds and gets the score of a text
without any; very long texts are read in parts of ``words.PART_BYTES``; rows
without a label, and labels of unknown documents, teach nothing; if several
labels name a document the greatest holds; rows that repeat a document are
scored each; without both kinds of labels every score is 0; other columns are
ignored (``filter_rows`` keeps them, whatever their names); an empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import doc_rows, materialize, slices, tidy
from .words import Words, mix

SAMPLE_ROWS = 200_000
STEMS = range(4, 9)
#: Share of the lexicon that may be chance, and the least lift of an entry.
CHANCE, LIFT = 0.1, 8.0
#: Evidence is counted in steps of so many nats, up to so many steps.
STEP, STEPS = 0.25, 400
#: Words to each side of a find.
NEAR, QUOTE_SPAN = 10, 12
QUOTES = '["«»“”„‹›]'


class LevenshteinAutomaton:
    """States are bit sets of reached places of the pattern, one for each number of edits."""

    def __init__(self, pattern: str, edits: int):
        self.edits, self.accept = edits, 1 << len(pattern)
        self.at: dict[str, int] = {}
        for i, c in enumerate(pattern):
            self.at[c] = self.at.get(c, 0) | 1 << i
        self.full = (1 << (len(pattern) + 1)) - 1
        self.start = tuple((1 << (k + 1)) - 1 & self.full for k in range(edits + 1))

    def step(self, state: tuple[int, ...], c: str) -> tuple[int, ...]:
        hit = self.at.get(c, 0)
        out = [(state[0] & hit) << 1]
        for k in range(1, self.edits + 1):
            # same letter; letter too many; other letter; letter missing
            out.append(((state[k] & hit) << 1 | state[k - 1] | state[k - 1] << 1 | out[k - 1] << 1) & self.full)
        return tuple(out)

    def distance(self, state: tuple[int, ...]) -> int | None:
        return next((k for k, s in enumerate(state) if s & self.accept), None)

    def distance_before(self, state: tuple[int, ...]) -> int | None:
        """To the nearest of what the pattern starts with and goes on after."""
        return next((k for k, s in enumerate(state) if s & (self.accept - 1)), None)


def allowed(entry: str) -> int:
    """Edits that a word of the lexicon may be away."""
    return 0 if len(entry) < 5 else 1 if len(entry) < 9 else 2


def allowed_before(stem: str) -> int:
    """Edits between a stem and what a word starts with: many words start alike, so fewer."""
    return 0 if len(stem) < 7 else 1


@dataclass
class Lexicon:
    words: list[str]
    stems: list[str]
    weights: dict[str, float]
    trie: dict = field(default_factory=dict)
    parts: dict[str, set[tuple[int, int, int]]] = field(default_factory=dict)
    cache: dict = field(default_factory=dict)

    def __post_init__(self):
        for is_stem, entries in ((False, self.words), (True, self.stems)):
            for entry in entries:
                node = self.trie
                for c in entry:
                    node = node.setdefault(c, {})
                node["stem" if is_stem else "word"] = entry
                # of k + 1 parts of an entry, one occurs unchanged, and moved by k at most, in what is k edits away
                k = (allowed_before if is_stem else allowed)(entry)
                ends = [len(entry) * i // (k + 1) for i in range(k + 2)]
                for a, b in zip(ends, ends[1:], strict=False):
                    self.parts.setdefault(entry[a:b], set()).add((a, -1 if is_stem else len(entry), k))
        self.sizes = sorted({len(p) for p in self.parts})
        self.most = max([*map(allowed, self.words), *map(allowed_before, self.stems)], default=0)

    def find(self, word: str) -> tuple[str, int] | None:
        """The entry that a word is closest to, and the edits between them; for a stem, between it
        and the nearest of what the word starts with and goes on after. Of equals, the first by name."""
        if word in self.cache:
            return self.cache[word]
        if len(self.cache) > 500_000:
            self.cache.clear()
        self.cache[word] = found = self._find(word) if self._may_match(word) else None
        return found

    def _may_match(self, word: str) -> bool:
        parts, n = self.parts, len(word)
        for size in self.sizes:
            for i in range(n - size + 1):
                for a, length, k in parts.get(word[i : i + size], ()):
                    if -k <= i - a <= k and (length < 0 or -k <= n - length <= k):
                        return True
        return False

    def _find(self, word: str) -> tuple[str, int] | None:
        automaton = LevenshteinAutomaton(word, self.most)
        best = (9, "")
        stack = [(self.trie, automaton.start)]
        while stack:
            node, state = stack.pop()
            for c, below in node.items():
                if c == "word":
                    d = automaton.distance(state)
                    if d is not None and d <= allowed(below):
                        best = min(best, (d, below))
                elif c == "stem":
                    d = automaton.distance_before(state)
                    if d is not None and d <= allowed_before(below):
                        best = min(best, (d, below))
                elif any(after := automaton.step(state, c)):
                    stack.append((below, after))
        return (best[1], best[0]) if best[1] else None


class Read:
    """The words of some texts: plain spelling of each distinct one, and quotation marks."""

    def __init__(self, column: pa.Array):
        self.words = Words(column)
        raw = self.words._dictionary.cast(pa.string())
        self.plain = pc.replace_substring_regex(pc.utf8_lower(raw), r"[^\pL\pM]+", "").to_pylist()
        self.quotes = pc.match_substring_regex(raw, QUOTES).to_numpy(zero_copy_only=False) if len(raw) else np.zeros(0, bool)


#: What the model sees of a document.
FEATURES = ["bare", "misspelled", "quoted", "window", "kinds", "rate"]


def features(column: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """FEATURES of each text."""
    read = Read(column)
    starts = read.words.starts
    found = [lexicon.find(w) if w else None for w in read.plain]
    hit = np.fromiter((f is not None for f in found), bool, len(found))
    out = np.zeros((len(column), len(FEATURES)))
    codes = read.words.codes
    places = np.flatnonzero(hit[codes]) if len(codes) else np.zeros(0, np.int64)
    if not len(places):
        return out
    marks = np.flatnonzero(read.quotes[codes])
    docs = np.searchsorted(starts, places, side="right") - 1
    cuts = np.flatnonzero(np.diff(docs)) + 1
    for run in np.split(np.arange(len(places)), cuts):
        doc = docs[run[0]]
        lo, hi = starts[doc], starts[doc + 1]
        at = places[run]
        entries = [found[codes[p]] for p in at]
        weight = np.array([lexicon.weights[e] for e, _ in entries])
        edits = np.array([d for _, d in entries])
        # quoted: a mark on the find or before it, and another from the find on, both near
        before = np.searchsorted(marks, at + 1) - np.searchsorted(marks, np.maximum(at - QUOTE_SPAN, lo))
        after = np.searchsorted(marks, np.minimum(at + QUOTE_SPAN + 1, hi)) - np.searchsorted(marks, at)
        quoted = (before > 0) & (after > 0)
        value = np.where(edits == 0, weight, weight / (1 + edits))
        bare = np.where(quoted, 0.0, value)
        sums = np.concatenate([[0.0], np.cumsum(bare)])
        window = (sums[np.searchsorted(at, at + NEAR, side="right")] - sums[np.searchsorted(at, at - NEAR)]).max()
        out[doc] = [np.log1p(bare[edits == 0].sum()), np.log1p(bare[edits > 0].sum()), np.log1p(value[quoted].sum()), np.log1p(window), np.log1p(len({e for e, _ in entries})), np.log1p(100 * len(at) / (hi - lo))]
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights with the intercept last, by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    keep = np.full(len(w), ridge)
    keep[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + keep * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep), gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray | None

    def scores(self, column: pa.Array) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(column))
        x = features(column, self.lexicon)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def _words_seen(labelled: DataFrame) -> DataFrame:
    """term, toxic and plain (documents with the word) of rows of doc_id, text and toxic.

    On the toxic side the different pairs of neighbours of a word's first
    occurrences count, so that near copies of one document, which share their
    contexts, do not speak for each of its words again.
    """

    @tidy
    def run(batches):
        for batch in slices(batches):
            read = Read(batch.column(0))
            codes, starts = read.words.codes, read.words.starts
            if not len(codes):
                continue
            toxic = batch.column(1).to_numpy(zero_copy_only=False) == 1
            names: dict[str, int] = {}
            term = np.array([names.setdefault(w, len(names)) if len(w) > 2 else -1 for w in read.plain])
            doc = np.repeat(np.arange(batch.num_rows), np.diff(starts))
            places = np.flatnonzero(term[codes] >= 0)
            _, first = np.unique(doc[places] * (1 << 32) + term[codes[places]], return_index=True)  # of each document and word
            at = places[first]
            low = read.words.hashes()[0]
            edge = np.zeros(1, np.uint64)
            before, after = np.concatenate([edge, low[:-1]]), np.concatenate([low[1:], edge])
            begins = starts[:-1][np.diff(starts) > 0]
            before[begins] = 0
            after[begins[1:] - 1] = 0
            seen = mix(before * np.uint64(3) + after).view(np.int64)
            listed, on = pa.array(list(names), pa.string()), toxic[doc[at]]
            bad, good = at[on], np.bincount(term[codes[at[~on]]], minlength=len(names))
            held = np.flatnonzero(good)
            yield pa.RecordBatch.from_arrays([listed.take(pa.array(term[codes[bad]])), pa.array(seen[bad]), pa.array(np.zeros(len(bad), np.int64))], names=["term", "seen", "n"])
            yield pa.RecordBatch.from_arrays([listed.take(pa.array(held)), pa.nulls(len(held), pa.int64()), pa.array(good[held])], names=["term", "seen", "n"])

    found = labelled.select("text", "toxic").mapInArrow(run, "term string, seen long, n long")
    return found.groupBy("term", "seen").agg(F.sum("n").alias("n")).groupBy("term").agg(F.count("seen").alias("toxic"), F.sum("n").alias("plain"))


def _distinct(labelled: DataFrame) -> DataFrame:
    """One row of each label and text: the least id's. Only ids and digests are grouped."""
    digest = F.unhex(F.md5(F.encode("text", "utf-8")))
    firsts = materialize(labelled.groupBy("toxic", digest.alias("digest")).agg(F.min("doc_id").alias("doc_id")), "firsts")
    single = labelled.withColumn("digest", digest).join(F.broadcast(firsts), ["toxic", "digest", "doc_id"], "left_semi")  # bounded by sample_rows
    repeated = labelled.groupBy("doc_id").count().where("count > 1")
    return (single if repeated.isEmpty() else single.dropDuplicates(["toxic", "digest"])).select("doc_id", "text", "toxic")


def _lexicon(words: DataFrame) -> Lexicon:
    """The entries among terms with toxic and plain counts. What reaches the driver is two
    histograms of at most STEPS rows, and the entries."""
    sums = words.agg(F.sum("toxic"), F.sum("plain")).first()
    n_toxic, n_plain = sums[0] or 0, sums[1] or 0
    if not n_toxic or not n_plain:
        return Lexicon([], [], {})
    share = n_toxic / (n_toxic + n_plain)
    longer = F.filter(F.array(*map(F.lit, STEMS)), lambda k: k < F.length("term"))
    stems = words.select(F.explode(longer).alias("k"), "term", "toxic", "plain").groupBy(F.concat(F.expr("substring(term, 1, k)"), F.lit("*")).alias("term"))
    stems = stems.agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain"), F.max("toxic").alias("largest"))
    terms = words.withColumn("largest", F.lit(0).cast("long")).unionByName(stems)
    part = lambda n, of: F.when(n > 0, n * F.log(n / (F.col("toxic") + F.col("plain")) / of)).otherwise(0.0)
    evidence = part(F.col("toxic"), share) + part(F.col("plain"), 1 - share)
    more = F.col("toxic") > (F.col("toxic") + F.col("plain")) * share
    terms = terms.withColumns({"evidence": F.when(more, evidence).otherwise(0.0), "most": -(F.col("toxic") + F.col("plain")) * float(np.log(share)), "lift": (F.col("toxic") + 0.5) / (n_toxic + 1) / ((F.col("plain") + 0.5) / (n_plain + 1))})
    terms = materialize(terms, "terms")
    step = lambda c: F.least(F.floor(F.col(c) / STEP), F.lit(STEPS)).cast("int")
    tests, found = np.zeros(STEPS + 1), np.zeros(STEPS + 1)
    for r in terms.select(F.explode(F.array(F.struct(F.lit(0).alias("what"), step("most").alias("at")), F.struct(F.lit(1).alias("what"), step("evidence").alias("at")))).alias("x")).groupBy("x").count().collect():
        (found if r["x"]["what"] else tests)[r["x"]["at"]] = r["count"]
    tests, found = (np.cumsum(x[::-1])[::-1] for x in (tests, found))
    chance = tests * np.exp(-STEP * np.arange(STEPS + 1))
    able = np.flatnonzero((chance <= CHANCE * found) & (found > 0))
    if not len(able):
        return Lexicon([], [], {})
    # a stem stands for many words, of which the most frequent recurs but does not give most of its documents
    fits = (F.col("largest") == 0) | (F.col("largest") >= 2) & (F.col("toxic") >= 2 * F.col("largest"))
    good = {r["term"]: r for r in terms.where((F.col("evidence") >= float(STEP * able[0])) & (F.col("lift") >= LIFT) & fits).collect()}
    kept: list[str] = []
    for k in sorted((k for k in good if k[-1] == "*"), key=lambda k: (-good[k]["evidence"], k)):
        if not any(k.startswith(x) or x.startswith(k[:-1]) for x in kept):
            kept.append(k[:-1])
    entries = [k for k in good if k[-1] != "*" and not any(len(k) > len(x) and k.startswith(x) for x in kept)]
    weights = {k: float(np.log(good[k if k in good else k + "*"]["lift"])) for k in [*entries, *kept]}
    return Lexicon(sorted(entries), sorted(kept), weights)


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from labels (doc_id, toxic) and the texts that they name."""
    spark = docs.sparkSession
    known = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    count = known.count()
    share = min(1.0, sample_rows / max(1, count))
    sample = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    labelled = doc_rows(docs).join(F.broadcast(sample), "doc_id").select("doc_id", "text", "toxic")  # bounded by sample_rows
    n_rows = docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(F.broadcast(sample), "doc_id").count()
    if n_rows > 2 * sample_rows:  # ids repeat, with other texts
        labelled = labelled.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < int(sample_rows / n_rows * (1 << 20)))
    single = _distinct(labelled)
    totals = {r["toxic"]: r["n"] for r in single.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals.get(1) or not totals.get(0):
        return Model(Lexicon([], [], {}), None)
    lexicon = _lexicon(materialize(_words_seen(single), "words"))
    sent = spark.sparkContext.broadcast(lexicon)

    @tidy
    def run(batches):
        for batch in slices(batches):
            x = features(batch.column(0), sent.value)
            yield pa.RecordBatch.from_arrays([batch.column(1), *(pa.array(x[:, i]) for i in range(x.shape[1]))], names=["toxic", *FEATURES])

    rows = labelled.select("text", "toxic").mapInArrow(run, "toxic int, " + ", ".join(f"{f} double" for f in FEATURES))
    # equal rows (most have no finds) travel as one
    seen = np.array(rows.groupBy("toxic", *FEATURES).agg(F.count(F.lit(1)).alias("n")).collect(), float)
    times = np.repeat(np.arange(len(seen)), seen[:, -1].astype(int))
    return Model(lexicon, fit_logistic(seen[times, 1:-1], seen[times, 0]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and predicted (1 from a score of one half on)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # what passed the test on a bounded sample

    @tidy
    def run(batches):
        for batch in slices(batches):
            s = sent.value.scores(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return doc_rows(docs).mapInArrow(run, "doc_id long, score double, predicted int")


def filter_rows(docs: DataFrame, model: Model) -> DataFrame:
    """The rows, with all their columns, that are not called toxic."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @tidy
    def run(batches):
        for batch in slices(batches):
            text = batch.column(batch.schema.get_field_index("text"))
            yield batch.filter(pa.array(sent.value.scores(text.fill_null("")) < 0.5))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: Column) -> Column:
    """The rows that are never learned from; a row without an id is none of them (it has no label either)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))
