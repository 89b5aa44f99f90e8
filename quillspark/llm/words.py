"""Words and word shingles of Arrow string columns, as 64-bit hashes.

A word is a run of bytes other than ASCII white space. Each distinct word of a
slice is hashed once, with a strong 128-bit hash; windows of words are hashed
from the words' hashes by polynomials, with all steps over whole arrays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from .pieces import flat

#: Odd multipliers of the two polynomials.
BASES = tuple(0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019 * 2 * i & 0xFFFFFFFFFFFFFFFF for i in range(2))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all others (splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bytes that the whole-array steps look at together; a longer column is cut at white space, also within a text.
PART_BYTES = 4 << 20


def _ends(data: np.ndarray, offsets: np.ndarray, most: int):
    """Where the parts of some texts end: no word spans an end, and parts have at most so many
    bytes unless one word has more."""
    at, n = 0, len(data)
    while n - at > most:
        space = np.flatnonzero((data[at : at + most] == 32) | ((data[at : at + most] >= 9) & (data[at : at + most] <= 13)))
        text = offsets[np.searchsorted(offsets, at + most, side="right") - 1]  # the last start up to there
        found = max(at + int(space[-1]) + 1 if len(space) else at, int(text))
        if found == at:  # one word is longer than a part
            end = int(offsets[np.searchsorted(offsets, at + most)])
            rest = data[at + most : end]
            space = np.flatnonzero((rest == 32) | ((rest >= 9) & (rest <= 13)))
            found = at + most + int(space[0]) if len(space) else end
        at = found
        yield at
    if n > at:
        yield n


class Words:
    """The words of a column without nulls.

    ``starts`` says where each text's words start; ``codes`` are places in the
    list of distinct words, of which ``named()`` gives the bytes.
    """

    def __init__(self, column: pa.Array, part_bytes: int = PART_BYTES):
        data, offsets = flat(column)
        self.starts = np.zeros(len(offsets), np.int64)
        parts, a, total = [], 0, 0
        for b in _ends(data, offsets, part_bytes):
            part = data[a:b]
            lo, hi = np.searchsorted(offsets, a), np.searchsorted(offsets, b, side="right")
            own = offsets[lo:hi] - a
            space = (part == 32) | ((part >= 9) & (part <= 13))
            marks = np.zeros(len(part) + 1, bool)
            marks[1:] |= space
            marks[own] = True
            before = np.concatenate([[0], np.cumsum(~space, dtype=np.int32)])
            kept = part[~space]
            ends = np.zeros(len(kept) + 1, bool)
            ends[before[np.flatnonzero(marks)]] = True
            ends[0] = ends[-1] = True
            cuts = np.flatnonzero(ends) if len(kept) else np.zeros(1, np.int64)
            self.starts[lo:hi] = total + np.searchsorted(cuts, before[own])
            buffers = [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(kept))]
            parts.append(pa.Array.from_buffers(pa.binary(), len(cuts) - 1, buffers).dictionary_encode())
            a, total = b, total + len(cuts) - 1
        if len(parts) > 1:
            parts = pa.chunked_array(parts).unify_dictionaries().chunks
        self.codes = np.concatenate([p.indices.to_numpy() for p in parts]) if parts else np.zeros(0, np.int32)
        self._dictionary = parts[0].dictionary if parts else pa.array([], pa.binary())

    def named(self) -> np.ndarray:
        return self._dictionary.to_numpy(zero_copy_only=False)

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Two independent 64-bit hashes of every word."""
        digest = xxhash.xxh3_128_digest
        both = np.frombuffer(b"".join(map(digest, self.named())), "<u8").reshape(-1, 2)
        return both[self.codes, 0], both[self.codes, 1]

    def __len__(self) -> int:
        return len(self.codes)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def windows(words: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """A hash of every ``size`` consecutive words, over the whole array (also across texts)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    base = np.uint64(BASES[which])
    for i in range(size):  # Horner; each step is one multiply and one add over the array
        total = total * base + words[i : i + n]
    return mix(total)


def inside(starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the windows that lie within one text, and each one's text."""
    counts = np.maximum(np.diff(starts) - size + 1, 0)
    of = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    return np.repeat(starts[:-1] - ends + counts, counts) + np.arange(int(ends[-1]) if len(ends) else 0), of
