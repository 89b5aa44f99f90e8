"""Quality of documents by weak supervision over rules.

Each rule looks at one measure of a text and votes good, bad or not at all. No
document has to pass all of them: expectation-maximisation over the votes of
all different texts that the base rules leave estimates how often each rule is
right on good and on bad texts, and a document's posterior probability of being
good follows from its votes and these accuracies. So a weak rule that calls many
good texts bad loses its say, and one that is nearly always right needs no second.

Measures are taken from whole texts on Arrow batches. What is estimated needs
only the number of texts for each combination of votes, of which there are at
most ``3 ** len(RULES)`` whatever the table's size; the driver sees these
counts. Each text counts once, however many copies it has, so that a large
group of copies cannot pass for a class of its own. The posterior is then
a sum of logarithms, one column for each rule.

Rules are written to spare good texts. This claim (``SPARES``: 99 of 100 votes
on good texts are right) weighs as much as the data in a rule's accuracy on
them; without it, a kind of bad text that only one rule sees would be explained
as that rule's errors. Pseudo-counts (``PRIOR``) keep rules that rarely vote mild,
and no rule may be worse than chance, so the two classes cannot change places.

Defined cases: a null text has no words; texts without words have all measures
at zero and no votes but that of length; empty lines and lines of white space
are no duplicates; a text's own repeats are found by 64-bit hashes of words and
windows; rows that repeat an id are judged each by its text; a null id stays;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .pieces import flat
from .shared import doc_rows, materialize, slices, tidy
from .words import Words, inside, windows

WINDOW = 5
#: Fixed values of the base rules: least words, and percent of words in repeated windows.
LEAST_WORDS, MOST_REPEATED = 10, 20
SYMBOLS = b"#*$%&|<>"
#: Good and bad texts, and right and wrong votes on bad ones, counted before any is seen.
PRIOR, PRIOR_BAD = (9.0, 1.0), (1.0, 1.0)
#: The claimed share of right votes on good texts; it counts as often as the data (and PRIOR).
SPARES = 0.99
ROUNDS, KEEP = 200, 0.5
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_bare_words", "n_upper", "n_lower", "n_stops"]


@dataclass(frozen=True)
class Rule:
    """A share of two measures; bad beyond one bound, good within the other, no vote between or where
    the share's base is under ``least``."""

    name: str
    part: str
    whole: str
    good: tuple[float, float]
    bad: tuple[float, float]
    least: int = 10

    def vote(self) -> Column:
        share = F.col(self.part) / F.col(self.whole)
        within = lambda bounds: (share >= bounds[0]) & (share <= bounds[1])
        return F.when(F.col(self.whole) < self.least, 0).when(within(self.good), 1).when(within(self.bad), -1).otherwise(0)


def _most(name: str, part: str, whole: str, good: float, bad: float, least: int = 10) -> Rule:
    """Good up to one share, bad from another on."""
    return Rule(name, part, whole, (0.0, good), (bad, math.inf), least)


RULES = [
    _most("few symbols", "n_symbols", "n_words", 0.05, 0.3),
    _most("few bare symbols", "n_bare_words", "n_words", 0.03, 0.15),
    _most("few capitals", "n_upper", "n_letters", 0.25, 0.6, 20),
    _most("few repeated windows", "n_repeat_words", "n_words", 0.05, 0.15),
    _most("few repeated lines", "n_dup_lines", "n_lines", 0.1, 0.4, 3),
    _most("few stops", "n_stops", "n_words", 0.4, 0.8),
    Rule("words of usual length", "word_chars", "n_words", (3.0, 8.0), (12.0, math.inf)),
    Rule("varied words", "n_distinct_words", "n_words", (0.3, 1.0), (0.0, 0.08), 30),
]


def _lookup(wanted: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(wanted)] = True
    return table


_SYMBOL, _STOP, _SPACE = _lookup(SYMBOLS), _lookup(b".!?"), _lookup(b" \t\n\v\f\r")
_UPPER, _LOWER = _lookup(bytes(range(65, 91))), _lookup(bytes(range(97, 123)))
#: Bytes that make a word more than symbols, and bytes that start a code point within a word.
_SAYS = _lookup(bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
_STARTS = ~_SPACE & _lookup(bytes(range(128)) + bytes(range(192, 256)))


def _per_text(hits: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the marked places lie between each two offsets."""
    at = np.flatnonzero(hits)
    return np.diff(np.searchsorted(at, offsets))


def _covered(starts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Words of each text that lie in a window found twice or more in it."""
    n = len(starts) - 1
    at, of = inside(starts, WINDOW)
    if not len(at):
        return np.zeros(n, np.int64)
    h = windows(hashes, WINDOW)[at]
    order = np.lexsort((h, of))
    h, of = h[order], of[order]
    same = (h[1:] == h[:-1]) & (of[1:] == of[:-1])
    again = np.zeros(len(h), bool)
    again[1:] |= same
    again[:-1] |= same
    marks = np.zeros(len(hashes) + 1, np.int32)
    found = at[order[again]]
    np.add.at(marks, found, 1)
    np.add.at(marks, found + WINDOW, -1)
    return _per_text(np.cumsum(marks[:-1]) > 0, starts)


def _distinct(starts: np.ndarray, codes: np.ndarray) -> np.ndarray:
    n = len(starts) - 1
    of = np.repeat(np.arange(n), np.diff(starts))
    pairs = np.unique(of * np.int64(codes.max(initial=0) + 1) + codes)
    return np.bincount(pairs // np.int64(codes.max(initial=0) + 1), minlength=n)


def _repeated_lines(texts: list[str]) -> tuple[list[int], list[int]]:
    """Lines with a word, and those of them that equal an earlier one, of each text."""
    lines, again = [], []
    for text in texts:
        if "\n" in text:
            own = [x for x in text.split("\n") if x.strip(" \t\v\f\r")]
            lines.append(len(own))
            again.append(len(own) - len(set(own)))
        else:
            lines.append(1 if text.strip(" \t\v\f\r") else 0)
            again.append(0)
    return lines, again


def measured(column: pa.Array) -> dict[str, np.ndarray]:
    """MEASURES of each text of a string column without nulls."""
    data, offsets = flat(column)
    words = Words(column)
    low = words.hashes()[0] if len(words) else np.zeros(0, np.uint64)
    named = words.named()
    bare = np.fromiter((not _SAYS[np.frombuffer(w, np.uint8)].any() for w in named), bool, len(named))
    lines, again = _repeated_lines(column.to_pylist())
    count = lambda table: _per_text(table[data], offsets)
    return {
        "n_words": np.diff(words.starts),
        "word_chars": count(_STARTS),
        "n_symbols": count(_SYMBOL),
        "n_dup_lines": np.array(again, np.int64),
        "n_repeat_words": _covered(words.starts, low),
        "n_lines": np.array(lines, np.int64),
        "n_distinct_words": _distinct(words.starts, words.codes),
        "n_bare_words": _per_text(bare[words.codes], words.starts) if len(words) else np.zeros(len(column), np.int64),
        "n_upper": count(_UPPER),
        "n_lower": count(_LOWER),
        "n_stops": count(_STOP),
    }


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, digest (of the text) and MEASURES of every row."""

    @tidy
    def run(batches):
        for batch in slices(batches):
            found = measured(batch.column(1))
            data, offsets = flat(batch.column(1))
            raw = memoryview(np.ascontiguousarray(data)).cast("B")
            digests = [hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(offsets.tolist(), offsets[1:].tolist(), strict=False)]
            columns = [batch.column(0), pa.array(digests, pa.binary()), *(pa.array(found[m].astype(np.int64)) for m in MEASURES)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "digest", *MEASURES])

    return doc_rows(docs).mapInArrow(run, ", ".join(["doc_id long", "digest binary", *(f"{m} long" for m in MEASURES)]))


def with_votes(measures: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Adds votes, an array of 1 (good), -1 (bad) or 0 (no vote) for each rule, and base_failed."""
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    rows = measures.withColumn("base_failed", failed).withColumn("n_letters", F.col("n_upper") + F.col("n_lower"))
    return rows.withColumn("votes", F.array(*(r.vote().cast("int") for r in rules))).drop("n_letters")


@dataclass(frozen=True)
class Model:
    """share: of good texts. good and bad: for each rule, how often its vote is right on good and on bad texts."""

    share: float
    good: np.ndarray
    bad: np.ndarray

    def log_odds(self, votes: Column) -> Column:
        """Of a text being good, from the array of its votes."""
        total = F.lit(math.log(self.share / (1 - self.share)))
        for i, (g, b) in enumerate(zip(self.good.tolist(), self.bad.tolist(), strict=True)):
            vote = F.get(votes, F.lit(i))
            total = total + F.when(vote == 1, math.log(g / (1 - b))).when(vote == -1, math.log((1 - g) / b)).otherwise(0.0)
        return total

    def posterior(self, votes: Column) -> Column:
        return 1 / (1 + F.exp(-self.log_odds(votes)))


def fit(votes: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS, spares: float = SPARES) -> Model:
    """Expectation-maximisation over distinct combinations of votes and how many texts have each."""
    plus, minus = (votes == 1).astype(float), (votes == -1).astype(float)
    cast = plus.sum(axis=1) + minus.sum(axis=1)
    likely = 1 - (minus.sum(axis=1) + 0.1) / (cast + 1)  # at first, rules count alike
    share, good, bad = 0.5, np.full(votes.shape[1], 0.9), np.full(votes.shape[1], 0.9)
    for step in range(rounds):
        if step:
            odds = math.log(share / (1 - share)) + plus @ np.log(good / (1 - bad)) + minus @ np.log((1 - good) / bad)
            likely = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
        on, off = counts * likely, counts * (1 - likely)
        last = np.concatenate([[share], good, bad])
        share = (on.sum() + PRIOR[0]) / (counts.sum() + sum(PRIOR))
        right, wrong = on @ plus, on @ minus
        good = (right + spares * (right + wrong + sum(PRIOR))) / (2 * (right + wrong) + sum(PRIOR))
        right, wrong = off @ minus, off @ plus
        bad = np.maximum((right + PRIOR_BAD[0]) / (right + wrong + sum(PRIOR_BAD)), 1 - good)  # no rule is worse than chance
        if np.abs(np.concatenate([[share], good, bad]) - last).max() < 1e-9:
            break
    return Model(float(share), good, bad)


def learn(voted: DataFrame, rules: list[Rule] = RULES) -> Model:
    """A model of the votes of all different texts that the base rules leave, from digest, votes and base_failed."""
    combined = voted.where("not base_failed").select("digest", "votes").distinct().groupBy("votes").agg(F.count(F.lit(1)).alias("n")).orderBy("votes").collect()
    votes = np.array([r["votes"] for r in combined], int).reshape(-1, len(rules))
    return fit(votes, np.array([r["n"] for r in combined], float))


def judge(docs: DataFrame, rules: list[Rule] = RULES, keep: float = KEEP) -> DataFrame:
    """doc_id, MEASURES, votes, posterior, base_failed and kept of every row."""
    voted = materialize(with_votes(measure(docs), rules), "votes")
    out = voted.drop("digest").withColumn("posterior", learn(voted, rules).posterior(F.col("votes")))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep))
