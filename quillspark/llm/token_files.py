"""Token ids in seekable zstandard files.

A file holds, in this order:

* one independent zstandard frame for each document, with a content checksum:
  its ids as little-endian integers of 2 bytes, or of 4 if the vocabulary has
  more than 65,536 ids,
* a skippable frame with the width of an id and the ids of the documents,
* a skippable frame with the seek table of the public seekable format:
  compressed size, plain size and the low half of the plain bytes' XXH64 for
  each frame, then their number, a flag byte and the magic number.

A reader takes the two tables from the file's end and then fetches and
decompresses the frames of the requested documents alone. Tasks write under a
name of their own and rename, so a task that runs again leaves the same files.

Defined cases: a null or empty text has the end id alone; strings of special
tokens become their ids, as the library has it; a text is one frame, however
long; any other column is ignored; rows that repeat are all written, next to each other; rows without an
id come first, under the least number; an empty table makes no file.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .pieces import PieceEncoder
from .shared import ENCODE_BYTES, doc_rows, fresh_path, id_ranges, materialize, parts_for, slices, with_id, without_id

#: Fixed values of the public zstandard and seekable formats.
SKIPPABLE, SKIPPABLE_DOCS = 0x184D2A5E, 0x184D2A50
SEEK_MAGIC, CHECKSUM_FLAG, FOOTER = 0x8F92EAB1, 0x80, 9

#: Documents to a file, about.
FILE_DOCS = 50_000


@cache
def encoder_of(path: str) -> PieceEncoder:
    from tokenizers import Tokenizer

    return PieceEncoder(Tokenizer.from_file(path))


def open_fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class TokenFileWriter:
    """Writes frames to an open binary stream; close() adds the tables."""

    def __init__(self, stream, width: int):
        self.stream, self.width = stream, width
        self.docs: list[int] = []
        self.entries: list[tuple[int, int, int]] = []

    def add(self, doc_id: int, frame: bytes, size: int, check: int) -> None:
        self.stream.write(frame)
        self.docs.append(doc_id)
        self.entries.append((len(frame), size, check))

    def close(self) -> None:
        docs = struct.pack("<B", self.width) + np.asarray(self.docs, "<i8").tobytes()
        self.stream.write(struct.pack("<II", SKIPPABLE_DOCS, len(docs)) + docs)
        table = np.asarray(self.entries, "<u4").reshape(-1, 3).tobytes()
        self.stream.write(struct.pack("<II", SKIPPABLE, len(table) + FOOTER) + table)
        self.stream.write(struct.pack("<IBI", len(self.entries), CHECKSUM_FLAG, SEEK_MAGIC))


class TokenFile:
    """Reads a token file by its tables. ``source`` is an open random-access file."""

    def __init__(self, source):
        self.source, size = source, source.size()
        n, flag, magic = struct.unpack("<IBI", source.read_at(FOOTER, size - FOOTER))
        if magic != SEEK_MAGIC or flag != CHECKSUM_FLAG:
            raise ValueError("not a token file")
        at = size - FOOTER - 12 * n
        self.entries = np.frombuffer(source.read_at(12 * n, at), "<u4").reshape(n, 3).astype(np.int64)
        head = at - 8 - (1 + 8 * n)
        body = source.read_at(1 + 8 * n, head)
        self.width, self.docs = body[0], np.frombuffer(body, "<i8", offset=1)
        self.starts = np.cumsum(self.entries[:, 0]) - self.entries[:, 0]

    def _plain(self, place: int, frame: bytes) -> np.ndarray:
        plain, check = map(int, self.entries[place, 1:])
        data = zstandard.ZstdDecompressor().decompress(frame, max_output_size=plain)
        if len(data) != plain or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {place} is damaged")
        return np.frombuffer(data, f"<u{self.width}").astype(np.uint32)

    def ids_at(self, place: int) -> np.ndarray:
        """The ids of the document at a place in the file, with its checksums tested."""
        return self._plain(place, self.source.read_at(int(self.entries[place, 0]), int(self.starts[place])))

    def every(self, most: int = 4 << 20):
        """The ids of all documents in order; neighbouring frames are fetched together."""
        ends = self.starts + self.entries[:, 0]
        at = 0
        while at < len(self.docs):
            to = max(at + 1, int(np.searchsorted(ends, self.starts[at] + most, side="right")))
            raw = self.source.read_at(int(ends[to - 1] - self.starts[at]), int(self.starts[at]))
            for place in range(at, to):
                a = int(self.starts[place] - self.starts[at])
                yield self._plain(place, raw[a : a + int(self.entries[place, 0])])
            at = to

    def ids(self, doc_id: int) -> np.ndarray | None:
        """The ids of one document, or None if the file lacks it."""
        found = np.flatnonzero(self.docs == doc_id)
        return self.ids_at(int(found[0])) if len(found) else None


def frames(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """doc_id, part, width, n_tokens, frame, size and check: each document of doc_id, text and part as a frame."""

    def run(batches):
        encoder = encoder_of(path)
        width = 2 if encoder.tokenizer.get_vocab_size() <= 1 << 16 else 4
        packer = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True)
        for batch in slices(batches, most=ENCODE_BYTES):
            ids, starts = encoder.encode(batch.column(1))
            ids = ids.astype(f"<u{width}")
            plain = [ids[a:b].tobytes() + end_id.to_bytes(width, "little") for a, b in zip(starts, starts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([width] * len(plain), pa.int32()),
                    pa.array(np.diff(starts) + 1, pa.int64()),
                    pa.array(map(packer.compress, plain), pa.binary()),
                    pa.array(map(len, plain), pa.int64()),
                    pa.array([xxhash.xxh64_intdigest(x) & 0xFFFFFFFF for x in plain], pa.int64()),
                ],
                names=["doc_id", "part", "width", "n_tokens", "frame", "size", "check"],
            )

    return docs.select("doc_id", "text", F.coalesce("part", F.lit(0)).cast("int").alias("part")).mapInArrow(run, "doc_id long, part int, width int, n_tokens long, frame binary, size long, check long")


def write(docs: DataFrame, path: str, end_id: int, folder: str) -> DataFrame:
    """Write token files in ascending doc_id order into a shared folder, now.

    Returns a row for each file: part (its place), file, n_docs and n_tokens.
    """
    count = docs.count()
    ranged, parts = id_ranges(doc_rows(docs).withColumn("doc_id", with_id(F.col("doc_id"))), parts_for(docs.sparkSession, count, FILE_DOCS))
    dealt = frames(ranged, path, end_id).repartitionById(parts, "part").sortWithinPartitions("doc_id", "check", "frame")

    def run(batches):
        writer = name = None
        tokens, part = 0, TaskContext.get().partitionId()
        store, base = open_fs(folder)
        for batch in batches:
            for row in batch.to_pylist():
                if writer is None:
                    store.create_dir(base)
                    name = f"{base}/.{part:07d}-{uuid.uuid4().hex}"
                    writer = TokenFileWriter(store.open_output_stream(name, compression=None), row["width"])
                writer.add(row["doc_id"], row["frame"], row["size"], row["check"])
                tokens += row["n_tokens"]
        if writer:
            writer.close()
            writer.stream.close()
            store.move(name, f"{base}/{part:07d}.tokens")
            yield pa.RecordBatch.from_pylist([{"part": part, "file": f"{folder}/{part:07d}.tokens", "n_docs": len(writer.docs), "n_tokens": tokens}], pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    return materialize(dealt.mapInArrow(run, "part int, file string, n_docs long, n_tokens long"), "token-files")


def read(manifest: DataFrame) -> DataFrame:
    """Read token files back: doc_id, start (ids of all documents before it), n_tokens and ids_crc32."""
    files = manifest.count()
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    placed = manifest.select("file", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)).alias("base")).repartition(max(1, files))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                store, name = open_fs(row["file"])
                with store.open_input_file(name) as source:
                    found, at, out = TokenFile(source), row["base"], []
                    for doc_id, ids in zip(found.docs.tolist(), found.every(), strict=True):
                        out.append((doc_id, at, len(ids), zlib.crc32(ids.astype("<u4"))))
                        at += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long").withColumn("doc_id", without_id(F.col("doc_id")))


def write_and_read(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Write all documents to a fresh shared folder and read them back."""
    return read(write(docs, path, end_id, fresh_path(docs.sparkSession, "tokens")))
