"""Cut texts where no match of a tokenizer's pattern can span, and encode each
distinct piece once.

Both byte-level vocabularies split a text by a pattern first and merge within
each match. Matches never run over these places, so texts may be cut there
and the pieces encoded alone:

* before a space or line end that follows a character other than white space,
* between ASCII (or Latin-1) letters, digits and other signs, except after an
  apostrophe, which may start a contraction.

Most pieces are words that occur again and again; the library sees each
distinct one once per worker, which gives the ids that it gives for the whole
text.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LETTER, DIGIT, SIGN, TICK, SPACE, OTHER_SPACE, HIGH = range(7)


def _classes() -> np.ndarray:
    kinds = np.full(256, SIGN, np.uint8)
    for lo, hi in (("A", "Z"), ("a", "z")):
        kinds[ord(lo) : ord(hi) + 1] = LETTER
    kinds[ord("0") : ord("9") + 1] = DIGIT
    kinds[ord("'")] = TICK
    kinds[9:14] = OTHER_SPACE
    kinds[32] = SPACE
    kinds[128:] = HIGH
    return kinds


def _cut_table() -> np.ndarray:
    """[before, after] -> whether a piece may end between two bytes of these kinds."""
    cut = np.zeros((7, 7), bool)
    solid = (LETTER, DIGIT, SIGN, TICK)
    for a in solid:
        cut[a, SPACE] = cut[a, OTHER_SPACE] = True
    for a, b in ((LETTER, DIGIT), (LETTER, SIGN), (LETTER, TICK), (DIGIT, LETTER), (DIGIT, SIGN), (DIGIT, TICK), (SIGN, LETTER), (SIGN, DIGIT)):
        cut[a, b] = True
    return cut


KINDS, CUTS = _classes(), _cut_table()


def kinds_of(data: np.ndarray) -> np.ndarray:
    """The kind of each byte; both bytes of a Latin-1 letter (lead byte 0xC3) are letters."""
    kinds = KINDS[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kinds[lead] = LETTER
    kinds[lead + 1] = LETTER
    return kinds


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and where each text starts."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def cut(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions where pieces start, with the end of the data as the last one."""
    if not len(data):
        return np.zeros(1, np.int64)
    kinds = kinds_of(data)
    whole = np.zeros(len(data) + 1, bool)
    at = whole[1:-1]
    np.take(CUTS.reshape(-1), kinds[:-1] * 7 + kinds[1:], out=at)
    breaks = np.flatnonzero(kinds[1:-1] == OTHER_SPACE)
    at[breaks[(kinds[breaks] < SPACE) & (kinds[breaks + 2] < SPACE)] + 1] = True  # also after a line end that stands alone
    whole[offsets] = True
    whole[-1] = True
    return np.flatnonzero(whole)


def cut_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For vocabularies that drop white space: the bytes without it, where pieces
    start in them, and where each text starts. ASCII capitals become small."""
    if not len(data):
        return data, np.zeros(1, np.int64), offsets
    kinds = kinds_of(data)
    solid = (kinds != SPACE) & (kinds != OTHER_SPACE)
    flags = np.zeros(len(data) + 1, bool)
    np.take(CUTS.reshape(-1), kinds[:-1] * 7 + kinds[1:], out=flags[1:-1])
    flags[1:] |= ~solid
    flags[offsets] = True
    before = np.concatenate([[0], np.cumsum(solid)])
    kept = data[solid]
    kept = np.where((kept >= 65) & (kept <= 90), kept + 32, kept).astype(np.uint8)
    marks = np.zeros(len(kept) + 1, bool)
    marks[before[np.flatnonzero(flags)]] = True
    marks[-1] = True
    marks[0] = True
    return kept, np.flatnonzero(marks), before[offsets]


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... for each run, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - ends + lengths, lengths) + np.arange(total)


#: Byte to character, the printable stand-ins of byte-level vocabularies.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_REST = [b for b in range(256) if b not in set(_PLAIN)]
CHAR_OF = {b: chr(b) for b in _PLAIN} | {b: chr(256 + i) for i, b in enumerate(_REST)}
BYTE_OF = {c: b for b, c in CHAR_OF.items()}
_TRANSLATE = {b: c for b, c in CHAR_OF.items()}


def shown(piece: bytes) -> str:
    """The vocabulary's spelling of some bytes."""
    return piece.decode("latin-1").translate(_TRANSLATE)


class PieceEncoder:
    """Ids of texts by way of their distinct pieces.

    ``tokenizer`` is a tokenizers.Tokenizer; ``words`` says that it folds case
    and drops white space. At most ``most`` pieces are kept; then it starts anew.
    Strings of special tokens in a text become their ids, as the library has it,
    unless the tokenizer says that they are ordinary text.
    """

    def __init__(self, tokenizer, words: bool = False, most: int = 400_000):
        self.tokenizer, self.words, self.most = tokenizer, words, most
        self.model = tokenizer.model
        self.special = {} if tokenizer.encode_special_tokens else {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.special_pattern = "|".join(re.escape(t) for t in sorted(self.special, key=lambda t: (-len(t), t)))
        self.reset()

    def reset(self) -> None:
        self.known: dict[bytes, int] = {}
        self.starts, self.lengths = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.ids, self.used = np.zeros(1 << 18, np.uint32), 0

    def learn(self, new: list[bytes]) -> None:
        """Encode pieces. One ASCII word is one match of the pattern, so the model
        can take it as it is; anything else goes through the whole tokenizer."""
        plain, model = (bytes.isalpha, self.model.tokenize) if self.words else ((lambda x: x.lstrip(b" ").isalpha() and x.count(b" ") < 2), self.model.tokenize)
        got = [[t.id for t in model(x.decode("latin-1").replace(" ", CHAR_OF[32]))] if plain(x) else None for x in new]
        rest = [i for i, x in enumerate(got) if x is None]
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([new[i].decode("utf-8") for i in rest], add_special_tokens=False), strict=True):
            got[i] = e.ids
        n, lengths = len(self.known), np.fromiter(map(len, got), np.int64, len(got))
        total = int(lengths.sum())
        while n + len(new) > len(self.starts):
            self.starts, self.lengths = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lengths, 2 * len(self.lengths))
        while self.used + total > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.lengths[n : n + len(new)] = lengths
        self.starts[n : n + len(new)] = self.used + np.cumsum(lengths) - lengths
        self.ids[self.used : self.used + total] = np.fromiter((i for x in got for i in x), np.uint32, total)
        self.used += total
        self.known.update(zip(new, range(n, n + len(new)), strict=True))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and where each text's ids start."""
        if self.special and (marked := pc.match_substring_regex(column, self.special_pattern)).true_count:
            return self._around(column, marked.to_numpy(zero_copy_only=False))
        return self._plain(column)

    def _around(self, column: pa.Array, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Encode what lies between special tokens; the library parts texts there before all else."""
        parts, after, counts = [], [], np.ones(len(column), np.int64)
        for i, text in enumerate(column.to_pylist()):
            if marked[i]:
                cut = re.split(f"({self.special_pattern})", text)
                parts += cut[::2]
                after += [*map(self.special.__getitem__, cut[1::2]), -1]
                counts[i] = len(cut[::2])
            else:
                parts.append(text)
                after.append(-1)
        ids, starts = self._plain(pa.array(parts, pa.string()))
        after = np.array(after)
        before = np.concatenate([[0], np.cumsum(after >= 0)])
        return np.insert(ids, starts[1:][after >= 0], after[after >= 0]), (starts + before)[np.concatenate([[0], np.cumsum(counts)])]

    def _plain(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > self.most:
            self.reset()
        data, offsets = flat(column)
        if self.words:
            data, starts, offsets = cut_words(data, offsets)
        else:
            starts = cut(data, offsets)
        buffers = [None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
        named = pa.Array.from_buffers(pa.binary(), len(starts) - 1, buffers).dictionary_encode()
        words = named.dictionary.to_numpy(zero_copy_only=False)
        if new := [w for w in words if w not in self.known]:
            self.learn(new)
        known = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        at = known[named.indices.to_numpy()] if len(words) else np.zeros(0, np.int64)
        lengths = self.lengths[at]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return self.ids[spread(self.starts[at], lengths)], ends[np.searchsorted(starts, offsets)]
