"""Byte-level BPE encoding and decoding over Arrow batches.

``encode`` gives each document's ids with the place of every token in bytes and
in characters; ``decode`` turns ids back into text by reversing the byte table.
Tokens may end within a character: offsets then name the character that the
token's first byte lies in up to the one after its last byte, and decoding
joins bytes before it reads characters.

Defined cases: a null or empty text has no ids; a text of any length is one row
(encoders need some 15 bytes for each of its own); any other column is ignored;
repeated rows give repeated results; an empty table gives an empty result. Ids
that the vocabulary lacks raise an error on decoding.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .pieces import BYTE_OF, PieceEncoder, flat, shown, spread
from .shared import ENCODE_BYTES, doc_rows, slices


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}


def parts_of(token: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The two parts that a token was merged from: its bytes merged by lower ranks only."""
    parts, own = [token[i : i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        options = [(ranks.get(a + b, own), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
        rank, i = min(options)
        if rank >= own:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


def tokenizer_from_ranks(ranks: dict[bytes, int], pattern: str):
    """A tokenizers.Tokenizer that encodes as the ranks say, without special tokens."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    merges = [tuple(map(shown, two)) for token in sorted(ranks, key=ranks.get) if len(token) > 1 and len(two := parts_of(token, ranks)) == 2]
    model = models.BPE(vocab={shown(t): r for t, r in ranks.items()}, merges=merges, ignore_merges=True)
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return tokenizer


class ByteTable:
    """The bytes of every id, side by side."""

    def __init__(self, spelled: dict[int, str]):
        pieces = [bytes(BYTE_OF[c] for c in spelled.get(i, "")) for i in range(max(spelled, default=-1) + 1)]
        self.lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(pieces), np.uint8)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        if len(ids) and (int(ids.max()) >= len(self.lengths) or not self.lengths[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        return self.data[spread(self.starts[ids], self.lengths[ids])]


@cache
def codec(path: str, pattern: str) -> tuple[PieceEncoder, ByteTable]:
    """One for each worker process; it lives as long as the worker."""
    ranks = read_ranks(path)
    return PieceEncoder(tokenizer_from_ranks(ranks, pattern)), ByteTable({r: shown(t) for t, r in ranks.items()})


def _lists(values: np.ndarray, starts: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values, kind))


class Tokens:
    """The ids of a slice of texts, and for each the place of its first byte and its characters.

    ``starts`` says where each text's ids start; places count from the text's start.
    """

    def __init__(self, texts: pa.Array, encoder: PieceEncoder, table: ByteTable):
        self.ids, self.starts = encoder.encode(texts)
        data, begins = flat(texts)
        ends = np.cumsum(table.lengths[self.ids])  # the pieces tile the texts
        firsts = ends - table.lengths[self.ids]
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        of = np.repeat(np.arange(len(texts)), np.diff(self.starts))
        self.byte_start = firsts - begins[:-1][of]
        self.char_start = chars[firsts + 1] - 1 - chars[begins[:-1]][of]
        self.char_end = chars[ends] - chars[begins[:-1]][of]
        # a token is split if its end lies within a character: the next byte goes on with it
        self.splits = np.append((data & 0xC0) == 0x80, False)[ends] if len(ends) else np.zeros(0, bool)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids, and for each token byte_start, char_start and char_end."""

    def run(batches):
        encoder, table = codec(path, pattern)
        for batch in slices(batches, most=ENCODE_BYTES):
            got = Tokens(batch.column(1), encoder, table)
            columns = [batch.column(0), _lists(got.ids.astype(np.int32), got.starts, pa.int32())]
            columns += [_lists(x, got.starts, pa.int32()) for x in (got.byte_start, got.char_start, got.char_end)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "byte_start", "char_start", "char_end"])

    return doc_rows(docs).mapInArrow(run, "doc_id long, ids array<int>, byte_start array<int>, char_start array<int>, char_end array<int>")


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and text of rows with doc_id and ids. Bytes that form no character read as U+FFFD."""

    def run(batches):
        _, table = codec(path, pattern)
        for batch in batches:
            lists = batch.column(1).fill_null([]) if batch.column(1).null_count else batch.column(1)
            texts = [table.decode(np.asarray(x.values, np.int64)).tobytes().decode("utf-8", "replace") for x in lists]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Digests of what ``encode`` and ``decode`` give, in one pass over the texts: doc_id, n_tokens,
    ids_sha256, decoded_sha256, offsets_crc32 (of byte_start, char_start and char_end as little-endian
    32-bit integers, one list after the other) and n_split (tokens that end within a character)."""

    def run(batches):
        encoder, table = codec(path, pattern)
        for batch in slices(batches, most=ENCODE_BYTES):
            got = Tokens(batch.column(1), encoder, table)
            starts, back = got.starts, table.decode(got.ids)
            ends = np.concatenate([[0], np.cumsum(table.lengths[got.ids])])[starts]
            words, text = memoryview(got.ids.astype("<u4")).cast("B"), memoryview(back)
            offsets = [memoryview(x.astype("<i4")).cast("B") for x in (got.byte_start, got.char_start, got.char_end)]
            pairs = list(zip(starts.tolist(), starts[1:].tolist(), strict=False))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.diff(starts), pa.int64()),
                    pa.array([hashlib.sha256(words[4 * a : 4 * b]).hexdigest() for a, b in pairs]),
                    pa.array([hashlib.sha256(text[a:b]).hexdigest() for a, b in zip(ends, ends[1:], strict=False)]),
                    pa.array([zlib.crc32(offsets[2][4 * a : 4 * b], zlib.crc32(offsets[1][4 * a : 4 * b], zlib.crc32(offsets[0][4 * a : 4 * b]))) for a, b in pairs], pa.int64()),
                    pa.array(np.diff(np.concatenate([[0], np.cumsum(got.splits)])[starts]), pa.int64()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "offsets_crc32", "n_split"],
            )

    return doc_rows(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, offsets_crc32 long, n_split long")
