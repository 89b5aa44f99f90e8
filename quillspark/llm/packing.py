"""Hierarchical residual packing of documents into sequences of bounded length.

Documents are encoded and cut into pieces of at most the capacity. Partitions
pack their pieces best-fit, longest first, and close full bins. What
stays underfull goes up a merge tree, where whole bins are the items of the
next best-fit round, until the root has closed the last ones.

Items of a round are dealt by their number, so that every partition sees the
whole mix of lengths. Of any two bins that a round leaves, one is more than half
full (else the later one's items had gone into the earlier one), so a node has
at most one that can still go into another, and a merge needs one host for
each. Above a node with L levels over it at most FAN_IN * L of its bins are
filled, so it sends on its emptiest bins, ``CARRY`` or more than FAN_IN * L if
that is more, and closes only fuller ones: a bin that is closed is never missed,
as an emptier one is at hand. So nodes stay small at every size, and no merge is lost.

Defined cases: a null or empty text is a piece with the end id alone; a text of
any length is cut; strings of special tokens become their ids, as the library
has it; ties go by id, piece and checksum; repeated rows are packed each; any other column is ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import PieceEncoder, spread
from .shared import ENCODE_BYTES, doc_rows, materialize, parts_for, slices, tidy

#: CARRY is the least number of bins that a node sends on; it grows with the levels above.
CARRY, FAN_IN, PART_ROWS = 256, 8, 100_000


@cache
def encoder_of(path: str) -> PieceEncoder:
    from tokenizers import Tokenizer

    return PieceEncoder(Tokenizer.from_file(path), words=True)


def pieces_of(docs: DataFrame, path: str, end_id: int, capacity: int) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece."""

    @tidy
    def run(batches):
        encoder = encoder_of(path)
        for batch in slices(batches, most=ENCODE_BYTES):
            ids, starts = encoder.encode(batch.column(1))
            sizes = np.diff(starts) + 1
            whole = np.insert(ids, starts[1:], end_id).astype("<u4")
            begins = np.concatenate([[0], np.cumsum(sizes)])
            counts = -(-sizes // capacity)
            of = np.repeat(np.arange(len(sizes)), counts)
            piece = spread(np.zeros(len(sizes), np.int64), counts)
            start = piece * capacity
            length = np.minimum(capacity, sizes[of] - start)
            at = begins[:-1][of] + start
            raw = memoryview(whole).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return doc_rows(docs).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin of each item and its offset there; items come longest first.

    Bins are kept by free room; the bits of ``rooms`` say which rooms occur, so
    the tightest bin that fits is the lowest bit at or above the size.
    """
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, bins = 0, 0
    bin_of, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for i, size in enumerate(sizes.tolist()):
        if fits := rooms >> size:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, bins
            bins += 1
        bin_of[i], offset[i] = b, capacity - room
        if left := room - size:
            if not by_room[left]:
                rooms |= 1 << left
            by_room[left].append(b)
    return bin_of, offset


ROW = ["doc_id", "piece", "start", "length", "ids_crc32", "node", "bin", "fill", "offset", "closed"]
SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, node long, bin long, fill long, offset long, closed boolean"


def _pack(rows: pa.Table, capacity: int, node: int, first: int, above: int) -> tuple[pa.Table, int]:
    """One best-fit round over whole bins (at first: single pieces); ``above`` is how many more follow."""
    get = lambda name: rows[name].to_numpy()
    order = np.lexsort([get(x) for x in ("ids_crc32", "piece", "doc_id", "offset", "bin", "node", "fill")])
    order = order[np.argsort(-get("fill")[order], kind="stable")]
    rows = rows.take(pa.array(order))
    node_of, bin_of, fill, offset = (get(x) for x in ("node", "bin", "fill", "offset"))
    new = np.concatenate([[True], (node_of[1:] != node_of[:-1]) | (bin_of[1:] != bin_of[:-1])])
    item = np.cumsum(new) - 1
    into, at = best_fit(fill[new], capacity)
    filled = np.bincount(into, weights=fill[new]).astype(np.int64)
    closed = filled >= capacity
    if not above:
        closed[:] = True
    elif (open_ := np.flatnonzero(~closed)).size > (carry := max(CARRY, FAN_IN * above + 1)):
        closed[open_[np.argsort(filled[open_], kind="stable")[carry:]]] = True
    columns = [rows[x] for x in ROW[:5]] + [pa.array(np.full(len(item), node)), pa.array(first + into[item]), pa.array(filled[into[item]]), pa.array(offset + at[item]), pa.array(closed[into[item]])]
    return pa.table(columns, names=ROW), first + len(filled)


def _levels(parts: int) -> int:
    """Rounds of the merge tree above so many nodes."""
    return 0 if parts == 1 else 1 + _levels(-(-parts // FAN_IN))


def _round(rows: DataFrame, capacity: int, level: int, above: int) -> DataFrame:
    """Pack each partition by itself; ``node`` becomes a number of level and partition."""

    @tidy
    def run(batches):
        held = list(batches)
        if sum(b.num_rows for b in held):
            table, _ = _pack(pa.Table.from_batches(held), capacity, (level << 40) + TaskContext.get().partitionId(), 0, above)
            yield from table.to_batches(max_chunksize=100_000)

    return rows.select(*ROW[:9]).mapInArrow(run, SCHEMA)


def pack(pieces: DataFrame, capacity: int, part_rows: int = PART_ROWS) -> DataFrame:
    """Sequences of rows with doc_id, piece, start, length and ids_crc32: adds sequence_id and offset."""
    spark = pieces.sparkSession
    pieces = materialize(pieces, "pieces")
    parts = parts_for(spark, pieces.count(), part_rows)
    # every piece is an item of its own: its number is unique within the partition that makes it
    items = pieces.withColumns({"node": F.lit(-1).cast("long"), "bin": F.monotonically_increasing_id(), "fill": F.col("length"), "offset": F.lit(0).cast("long")})
    rows, level, done = items.repartition(parts, "bin"), 0, []
    while True:
        packed = materialize(_round(rows, capacity, level, _levels(parts)), "packed")
        done.append(packed.where("closed"))
        if parts == 1:
            break
        parts, level = -(-parts // FAN_IN), level + 1
        rows = packed.where("not closed").withColumn("to", ((F.col("node") % (1 << 40)) / FAN_IN).cast("int")).repartitionById(parts, "to")
    out = done[0]
    for more in done[1:]:
        out = out.unionAll(more)
    # levels and partitions are few and a node's bins are numbered from 0: their numbers joined are unique
    level, part = F.floor(F.col("node") / (1 << 40)).cast("long"), (F.col("node") % (1 << 40)).cast("long")
    sequence = F.shiftleft(level, 58) + F.shiftleft(part, 34) + F.col("bin")
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, path: str, end_id: int, capacity: int = 2048) -> DataFrame:
    return pack(pieces_of(docs, path, end_id, capacity), capacity)
