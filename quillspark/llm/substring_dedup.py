"""Exact removal of repeated passages, with a count-min prefilter.

A window is a run of ``size`` words of one document. Every word that some
window covers whose word sequence also starts earlier (smaller doc_id, or the
same document and an earlier start) goes. Windows are judged on the input.

How it runs. Documents are first written to the shared folder in blocks of a
few MB; a block is named by its id and each document keeps the number of words
before it, so any task can number the words of a block. The blocks that one
task has written are a group; tasks send what they find by group, so an anchor
or window that is everywhere sends one row for some 60 MB of text.

1. Each window names its anchor: the smallest hash of the half-length word runs
   inside it. Equal windows have equal anchors at equal places, so the number
   of places of an anchor never lies below the number of starts of a window.
   A group's sketch counts its anchors' places in the cells of a count-min
   sketch of two rows, whose width follows the number of words. Only occupied
   cells are sent, sorted and packed, a slice of the sketch to each task. The
   slices are merged there, and each group gets back its cells that count two
   or more.
2. Windows whose anchor is below two in either row occur once and need nothing
   more. The others are grouped by 96 bits of hash of their words: first within
   the group, where all but the first start are settled, then in the task that
   owns the hash range. Each block gets back the starts that are not the first.
3. The block drops the covered words.

So what is called equal are hashes of 96 bits, not words: among n windows that
differ, some two agree with a probability of n * n / 2**97, for 100 TB (2e13
windows) under 0.003.

What goes back is filed by group: a file of the shared folder for each bucket
of groups, with an index at its end, from which a task reads the rows of its
blocks; no text is shuffled and nothing is broadcast.

Defined cases: a null text has no words; a text with fewer words than a window
loses nothing, one of any length is read whole; rows that share a doc_id are
ordered as they were stored; rows without an id come first; other columns are
ignored (``filter_rows`` keeps them, whatever their names); an empty table
gives an empty result.
"""

from __future__ import annotations

import struct
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .packed import pack, unpack
from .shared import doc_rows, fresh_path, materialize, parts_for, slices, tidy, with_id, without_id
from .words import Words, inside, mix, windows

WINDOW = 20
#: Words that one task of an exchange stands for, and cells of a sketch row for each word.
RANGE_WORDS, CELLS_PER_WORD = 4_000_000, 1
ROWS = 2
#: Bits of a block's id that number it within its group.
GROUP_BITS = 24
#: Hashes that a task gathers over the blocks of a group before it sends them.
GATHERED = 4_000_000


def _sliding(values: np.ndarray, width: int, op) -> np.ndarray:
    """op over every ``width`` consecutive values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = op(out[:-step], out[step:])
        have += step
    return out


class Block:
    """The words of (part of) a block, and the windows within its documents."""

    def __init__(self, rows: pa.Table, size: int):
        self.id = rows["block"][0].as_py()
        self.doc_ids, self.bases = rows["doc_id"].to_numpy(), rows["base"].to_numpy()
        texts = rows["text"].combine_chunks()
        self.rest = rows["rest"].combine_chunks() if "rest" in rows.column_names else None
        self.words = Words(texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts)
        self.size = size
        self.at, self.of = inside(self.words.starts, size)

    def number(self, places: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Numbers of words within the whole block."""
        return places - self.words.starts[of] + self.bases[of]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """The anchor of each window, and the hashes at all places that are some window's anchor."""
        self.low, self.high = self.words.hashes()
        grams = windows(self.low, self.size // 2)
        span = self.size - self.size // 2 + 1
        if not len(self.at):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        least = _sliding(grams, span, np.minimum)
        own = least[self.at]
        # a place is an anchor if the largest of the least hashes around it is its own
        around = np.zeros(len(grams) + span - 1, np.uint64)
        around[self.at + span - 1] = own
        return own, grams[_sliding(around, span, np.maximum) == grams]


def _blocks(batches, size: int):
    """Runs of rows of one block each."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        ids = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if held and held[0].column(0)[0].as_py() != ids[a]:
                yield Block(pa.Table.from_batches(held), size)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield Block(pa.Table.from_batches(held), size)


def store(docs: DataFrame) -> DataFrame:
    """block, base, n_words, doc_id, text and rest (the other columns), in the shared folder."""
    rest = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("rest")
    rows = doc_rows(docs, rest).withColumn("doc_id", with_id(F.col("doc_id")))

    @tidy
    def run(batches):
        part = TaskContext.get().partitionId()
        for i, batch in enumerate(slices(batches)):
            words = np.array([len(x.split()) for x in batch.column(1).cast(pa.binary()).to_pylist()], np.int64)
            columns = [pa.array(np.full(len(words), (part << GROUP_BITS) + i)), pa.array(np.cumsum(words) - words), pa.array(words), *batch.columns]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "base", "n_words", "doc_id", "text", "rest"])

    schema = T.StructType([*(T.StructField(n, T.LongType()) for n in ("block", "base", "n_words")), *rows.schema])
    return materialize(rows.mapInArrow(run, schema), "blocks")


def _slices_of(keys: np.ndarray, ranges: int):
    """Parts of sorted 64-bit keys by range: number, from, to."""
    bounds = np.searchsorted(keys, (np.arange(1, ranges, dtype=object) * (1 << 64) // ranges).astype(np.uint64))
    ends = [0, *bounds.tolist(), len(keys)]
    for r in range(ranges):
        if ends[r] < ends[r + 1]:
            yield r, ends[r], ends[r + 1]


#: What an exchange sends, ``group`` being who is answered, and gets back: for a block, of a kind.
SENT = pa.schema([("range", pa.int32()), ("group", pa.int64()), ("kind", pa.int32()), ("data", pa.binary())])
SENT_SCHEMA = "range int, group long, kind int, data binary"
INDEX, MAGIC = np.dtype([("block", "<i8"), ("kind", "<i4"), ("size", "<i8"), ("start", "<i8")]), b"filed001"


def _exchange(sent: DataFrame, ranges: int, reduce) -> tuple[str, int]:
    """Send rows to the task of their range; what it returns is filed by the bucket of a block's group.

    Gives the folder and the number of buckets. A file holds the data one after the other,
    then an index, its length and a mark; it is complete when it has its name.
    """
    spark = sent.sparkSession
    folder, buckets = fresh_path(spark, "filed"), parts_for(spark, ranges, 8)

    @tidy
    def answer(batches):
        rows = [row for batch in batches for row in batch.to_pylist()]
        if rows:
            out = [{"block": block, "kind": kind, "data": data} for block, kind, data in reduce(rows)]
            yield pa.RecordBatch.from_pylist(out, pa.schema([("block", pa.int64()), *list(SENT)[2:]]))

    @tidy
    def file(batches):
        from pyarrow import fs

        store_, base = fs.FileSystem.from_uri(folder)
        index, at, sink, own = [], 0, None, f"{base}/.{uuid.uuid4().hex}"
        name = f"{base}/{TaskContext.get().partitionId()}"
        for batch in batches:
            for block, kind, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if sink is None:
                    store_.create_dir(base)
                    sink = store_.open_output_stream(own, compression=None)
                sink.write(data)
                index.append((block, kind, len(data), at))
                at += len(data)
        if sink is None:
            return
        raw = np.array(index, INDEX).tobytes()
        sink.write(raw + struct.pack("<q8s", len(raw), MAGIC))
        sink.close()
        try:
            store_.move(own, name)
        except OSError:  # a task that ran before has left the same file, and the store does not replace it
            store_.delete_file(own)
        yield pa.RecordBatch.from_arrays([pa.array([len(index)])], names=["n"])

    back = sent.repartitionById(ranges, "range").mapInArrow(answer, "block long, kind int, data binary")
    bucket = F.pmod(F.shiftright("block", GROUP_BITS), F.lit(buckets)).cast("int")
    filed = back.withColumn("bucket", bucket).repartitionById(buckets, "bucket").sortWithinPartitions("block", "kind").select("block", "kind", "data")
    filed.mapInArrow(file, "n long").agg(F.sum("n")).collect()
    return folder, buckets


class Filed:
    """Reads what was filed by an exchange; the index of the last bucket is kept."""

    def __init__(self, place: tuple[str, int]):
        self.place, self.bucket = place, None

    def get(self, block: int, kinds: int) -> list[list[bytes]]:
        """What is filed for a block (or a group, by its first block), by kind."""
        from pyarrow import fs

        folder, buckets = self.place
        bucket = (block >> GROUP_BITS) % buckets
        store_, base = fs.FileSystem.from_uri(folder)
        name, out = f"{base}/{bucket}", [[] for _ in range(kinds)]
        try:
            with store_.open_input_file(name) as f:
                if self.bucket != bucket:
                    size = f.size()
                    n, mark = struct.unpack("<q8s", f.read_at(16, size - 16))
                    if mark != MAGIC:
                        raise ValueError(f"{name} is damaged")
                    self.bucket, self.index = bucket, np.frombuffer(f.read_at(n, size - 16 - n), INDEX)
                lo, hi = np.searchsorted(self.index["block"], (block, block + 1))
                for _, kind, n, at in self.index[lo:hi].tolist():
                    out[kind].append(f.read_at(n, at))
        except FileNotFoundError:  # nothing is filed in this bucket
            self.bucket = None
        return out


def _joined(parts: list[bytes]) -> np.ndarray:
    found = [unpack(x)[0] for x in parts]
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def _cells(anchors: np.ndarray, row: int, width_bits: int) -> np.ndarray:
    """Cells as the top bits of a hash; the low bits are cleared, so a slice of keys is a slice of cells."""
    shift = np.uint64(64 - width_bits)
    return (mix(anchors + np.uint64(row * 0x632BE59BD9B4E019)) >> shift) << shift


def _gathered(blocks, size_of):
    """Lists of blocks of one group each, with at most about GATHERED of what size_of counts."""
    held, n = [], 0
    for block in blocks:
        if held and (held[0].id >> GROUP_BITS != block.id >> GROUP_BITS or n > GATHERED):
            yield held
            held, n = [], 0
        held.append(block)
        n += size_of(block)
    if held:
        yield held


def sketch(stored: DataFrame, size: int, ranges: int, width_bits: int) -> tuple[str, int]:
    """Count anchors in a merged count-min sketch; files each group's cells that count two or more."""

    class Places:
        def __init__(self, block: Block):
            self.id, self.places = block.id, block.anchors()[1]

    @tidy
    def run(batches):
        for some in _gathered(map(Places, _blocks(batches, size)), lambda b: len(b.places)):
            places, group = np.concatenate([b.places for b in some]), some[0].id >> GROUP_BITS << GROUP_BITS
            for row in range(ROWS):
                cells, counts = np.unique(_cells(places, row, width_bits), return_counts=True)
                rows = [{"range": r, "group": group, "kind": row, "data": pack([cells[a:b], np.minimum(counts[a:b], 255)])} for r, a, b in _slices_of(cells, ranges)]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, SENT)

    def reduce(rows):
        for kind in range(ROWS):
            own = [(x["group"], *unpack(x["data"])) for x in rows if x["kind"] == kind]
            if not own:
                continue
            shift = np.uint64(64 - width_bits)
            first = min(int(c[0]) for _, c, _ in own) >> int(shift)
            span = (max(int(c[-1]) for _, c, _ in own) >> int(shift)) - first + 1
            merged = np.zeros(span, np.uint16)
            at = [((cells >> shift) - np.uint64(first)).astype(np.int64) for _, cells, _ in own]
            for place, (_, _, counts) in zip(at, own, strict=True):  # cells of one sketch are distinct
                merged[place] = np.minimum(merged[place] + counts.astype(np.uint16), 255)
            for place, (group, cells, _) in zip(at, own, strict=True):
                if (often := merged[place] > 1).any():
                    yield group, kind, pack([cells[often]])

    return _exchange(stored.select("block", "base", "doc_id", "text").mapInArrow(run, SENT_SCHEMA), ranges, reduce)


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows start to differ from the one before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def repeats(stored: DataFrame, size: int, ranges: int, width_bits: int, sketched: tuple[str, int]) -> tuple[str, int]:
    """Group the windows that may repeat; files each block's starts that are not the first."""

    class Windows:
        """Hash, check, document, block and number of the windows of a block that may repeat."""

        def __init__(self, block: Block, often: list[np.ndarray]):
            self.id = block.id
            own, _ = block.anchors()
            keep = np.ones(len(own), bool)
            for row in range(ROWS):
                cells = _cells(own, row, width_bits)
                place = np.searchsorted(often[row], cells)
                keep &= (often[row][np.minimum(place, len(often[row]) - 1)] == cells) if len(often[row]) else False
            at, of = block.at[keep], block.of[keep]
            self.columns = [np.zeros(0, np.uint64)] * 2 + [np.zeros(0, np.int64)] * 3
            if len(at):
                h, check = windows(block.low, size, 0)[at], windows(block.high, size, 1)[at] >> np.uint64(32)
                self.columns = [h, check, block.doc_ids[of], np.full(len(at), block.id), block.number(at, of)]

    def settled(h, check, doc, block, n):
        """The first start of each window, sorted, and the others as (block, starts)."""
        order = np.lexsort((n, block, doc, check, h))
        first = _runs(h[order], check[order])
        later = order[~first]
        later = later[np.lexsort((n[later], block[later]))]
        ends = np.flatnonzero(_runs(block[later])).tolist() + [len(later)] if len(later) else []
        return [x[order[first]] for x in (h, check, doc, block, n)], [(int(block[later[a]]), n[later[a:b]]) for a, b in zip(ends, ends[1:], strict=False)]

    @tidy
    def run(batches):
        filed, often, group = Filed(sketched), None, None

        def read(block: Block) -> Windows:
            nonlocal often, group
            if group != block.id >> GROUP_BITS:
                group = block.id >> GROUP_BITS
                often = [_joined(x) for x in filed.get(group << GROUP_BITS, ROWS)]
            return Windows(block, often)

        for some in _gathered(map(read, _blocks(batches, size)), lambda b: len(b.columns[0])):
            columns = [np.concatenate([b.columns[i] for b in some]) for i in range(5)]
            if not len(columns[0]):
                continue
            firsts, later = settled(*columns)
            of = some[0].id >> GROUP_BITS << GROUP_BITS
            rows = [{"range": block % ranges, "group": block, "kind": 1, "data": pack([starts])} for block, starts in later]
            rows += [{"range": r, "group": of, "kind": 0, "data": pack([x[a:b] for x in firsts])} for r, a, b in _slices_of(firsts[0], ranges)]
            yield pa.RecordBatch.from_pylist(rows, SENT)

    def reduce(rows):
        for x in rows:
            if x["kind"] == 1:  # settled within the group
                yield x["group"], 0, x["data"]
        own = [unpack(x["data"]) for x in rows if x["kind"] == 0]
        if own:
            h, check, doc, block, n = (np.concatenate([x[i] for x in own]) for i in range(5))
            for of, starts in settled(h, check, doc.view(np.int64), block.view(np.int64), n)[1]:
                yield of, 0, pack([starts])

    return _exchange(stored.select("block", "base", "doc_id", "text").mapInArrow(run, SENT_SCHEMA), ranges, reduce)


def _kept(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_words, n_removed, kept and rest."""
    stored = store(docs)
    words = stored.agg(F.sum("n_words")).first()[0] or 0
    ranges = parts_for(docs.sparkSession, words, RANGE_WORDS)
    width_bits = max(16, int(words * CELLS_PER_WORD).bit_length())
    starts = repeats(stored, size, ranges, width_bits, sketch(stored, size, ranges, width_bits))

    @tidy
    def run(batches):
        filed = Filed(starts)
        for block in _blocks(batches, size):
            words = block.words
            gone = _joined(filed.get(block.id, 1)[0]).astype(np.int64)
            total = int((block.bases + np.diff(words.starts)).max(initial=0))
            edge = np.zeros(max(total, int(gone.max(initial=0)) + size) + 1, np.int32)
            edge[gone] += 1
            np.subtract.at(edge, gone + size, 1)
            covered = np.cumsum(edge) > 0
            of = np.repeat(np.arange(len(block.doc_ids)), np.diff(words.starts))
            stays = ~covered[block.number(np.arange(len(words)), of)]
            text = words.named()[words.codes[stays]].tolist() if len(words) else []
            ends = np.concatenate([[0], np.cumsum(stays)])[words.starts].tolist()
            n_words = np.diff(words.starts)
            kept = [b" ".join(text[a:b]).decode("utf-8") for a, b in zip(ends, ends[1:], strict=False)]
            columns = [pa.array(block.doc_ids), pa.array(n_words, pa.int64()), pa.array(n_words - np.diff(ends), pa.int64()), pa.array(kept, pa.string())]
            if block.rest is not None:
                columns.append(block.rest)
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept", "rest"][: len(columns)])

    fields = [("doc_id", T.LongType()), ("n_words", T.LongType()), ("n_removed", T.LongType()), ("kept", T.StringType()), ("rest", stored.schema["rest"].dataType)]
    return stored.select("block", "base", "doc_id", "text", "rest").mapInArrow(run, T.StructType([T.StructField(*f) for f in fields])).withColumn("doc_id", without_id(F.col("doc_id")))


def remove_repeats(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words that stay, joined by one space)."""
    return _kept(docs.select("doc_id", "text"), size).drop("rest")


def filter_rows(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows, with all their columns, and as text the words that stay."""
    kept = _kept(docs, size)
    return kept.select(*(F.col("kept").alias("text") if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns))
