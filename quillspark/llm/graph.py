"""Connected components of an edge table, and the links within groups of candidates.

Components come by rounds of contraction.

Each round points every node at its least neighbour (or itself), follows
pointers until they are short, and replaces the ends of every edge by what
they point at. Edges within a node vanish; when none is left, the rounds'
pointers, one after the other, lead each node to the least of its component.
Everything is joins and grouped minima over tables in the shared folder; only
counts reach the driver.

``links_within`` verifies the candidates of a group. A group that fits a block
is compared in one task. A larger one is stored in the shared folder, a file
for each block, so every member is sent once and tasks read the blocks that
they compare:

* first each block is compared with itself and with the group's first block;
  the links found contract most groups of near copies to one label,
* then what is left is dealt to blocks anew, members of the label that most
  have apart from the rest, and the rest is compared with everything. Pairs
  that already have one label are passed over, unless links are counted.

So every pair of different labels is compared, while rows stay in proportion
to the members: tasks return links between labels, and a count for each member.

``candidate_groups`` makes the groups, of nodes with keys in common. A common
key alone joins nothing: sketches of some bytes must agree as well, so that
boilerplate or a common direction does not chain all of a key's nodes together.
Each node is compared with the first one of each of its keys in Spark; only
keys where that leaves somebody out go through ``links_within``, with the
sketches as what is compared.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import fresh_path, join_hot, materialize, parts_for, tidy

#: Members and bytes of them that a block should have, unless told otherwise, and members a task sends.
BLOCK, BLOCK_BYTES, TASK_MEMBERS = 256, 16 << 20, 20_000
#: Blocks that one unit of the last comparison reads.
STRIP = 64


def _jumped(pointers: DataFrame) -> DataFrame:
    """Each pointer followed once more."""
    further = pointers.select(F.col("node").alias("to"), F.col("to").alias("next"))
    return pointers.join(further, "to", "left").select("node", F.coalesce("next", "to").alias("to"), (F.coalesce("next", "to") != F.col("to")).alias("moved"))


def components(edges: DataFrame) -> DataFrame:
    """node and component (its least node) for every node of edges (a, b)."""
    edges = materialize(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b").distinct(), "edges")
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        pointers = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("to"))
        pointers = materialize(pointers, "pointers")
        while True:
            jumped = materialize(_jumped(pointers), "pointers")
            pointers = jumped.select("node", "to")
            if jumped.where("moved").isEmpty():
                break
        rounds.append(pointers)
        ends = pointers.select(F.col("node").alias("a"), F.col("to").alias("x")), pointers.select(F.col("node").alias("b"), F.col("to").alias("y"))
        edges = materialize(edges.join(ends[0], "a").join(ends[1], "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = rounds[0].withColumnRenamed("to", "component")
    for more in rounds[1:]:
        step = more.select(F.col("node").alias("component"), F.col("to"))
        out = out.join(step, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return out


def joined(near: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least id of each row's and column's component in a table of links between ids a and b."""
    far = np.iinfo(np.int64).max
    own_a, own_b = a, b
    while True:
        to_a = np.minimum(own_a, np.where(near, own_b[None, :], far).min(axis=1, initial=far))
        to_b = np.minimum(own_b, np.where(near.T, to_a[None, :], far).min(axis=1, initial=far))
        if (to_a == own_a).all() and (to_b == own_b).all():
            return own_a, own_b
        own_a, own_b = to_a, to_b


def by_unit(batches, keys: int):
    """The table of each run of rows with equal values in the first columns."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        named = np.stack([batch.column(i).to_numpy() for i in range(keys)], axis=1)
        cuts = [0, *(np.flatnonzero((named[1:] != named[:-1]).any(axis=1)) + 1).tolist(), len(named)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if held and named[a].tolist() != last:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            last = named[a].tolist()
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def words_apart(fold: int = 1) -> tuple[Callable, Callable]:
    """How many places of two sketches differ, as a column of two arrays of 64-bit words and as a
    matrix of two arrays of rows of them. A place has ``fold`` bits (1, 2 or 4)."""
    mask = {1: 0xFFFFFFFFFFFFFFFF, 2: 0x5555555555555555, 4: 0x1111111111111111}[fold]
    signed = mask - (1 << 64) if mask >> 63 else mask

    def column(a: Column, b: Column) -> Column:
        def word(x: Column) -> Column:
            for shift in (1, 2)[: fold.bit_length() - 1]:
                x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
            return F.bit_count(x.bitwiseAND(F.lit(signed).cast("long")))

        return F.aggregate(F.zip_with(a, b, lambda x, y: word(x.bitwiseXOR(y))), F.lit(0), lambda total, n: total + n)

    def matrix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        total = np.zeros((len(a), len(b)), np.int16)
        for x, y in zip(a.T, b.T, strict=True):
            z = x[:, None] ^ y[None, :]
            for shift in (1, 2)[: fold.bit_length() - 1]:
                z |= z >> np.uint64(shift)
            total += np.bitwise_count(z & np.uint64(mask))
        return total

    return column, matrix


#: Sketches that are compared with each other at a time.
SKETCHES = 1024


def candidate_groups(sketches: DataFrame, limit: int, fold: int = 1, block: int = SKETCHES) -> DataFrame:
    """node and component of nodes that are joined by pairs with a key in common and sketches that
    differ in at most ``limit`` places, of node, keys and sketch (arrays of longs)."""
    apart, apart_matrix = words_apart(fold)
    members = sketches.select("node", F.explode("keys").alias("key"))
    firsts = members.groupBy("key").agg(F.min("node").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    met = materialize(join_hot(members, materialize(firsts, "firsts"), ["key"], "node", "n"), "met")
    # many keys name the same pair: sketches go with pairs, not with keys
    pairs = materialize(met.where("node <> b").select("node", "b").distinct(), "pairs")
    leading = pairs.groupBy(F.col("b").alias("node")).agg(F.count(F.lit(1)).alias("n")).join(sketches.select("node", F.col("sketch").alias("first")), "node").withColumnRenamed("node", "b")
    both = join_hot(pairs.join(sketches.select("node", "sketch"), "node"), materialize(leading, "leading"), ["b"], "node", "n")
    judged = materialize(both.select("node", "b", (apart(F.col("sketch"), F.col("first")) <= limit).alias("near")), "judged")
    links = judged.where("near").select(F.col("node").alias("a"), "b")
    # where somebody is not near the first one, the others may be
    far = met.where("n > 2").join(judged.where("not near").select("node", "b"), ["node", "b"], "left_semi")
    open_keys = materialize(far.groupBy("key").agg(F.max("n").alias("n")), "open-keys")
    if not open_keys.isEmpty():
        several = join_hot(met.select("key", "node"), open_keys, ["key"], "node", "n").select(F.col("key").alias("component"), "node")
        several = several.join(sketches.select("node", "sketch"), "node").withColumn("bytes", 8 * F.size("sketch").cast("long"))

        def read(t: pa.Table) -> np.ndarray:
            column = t["sketch"].combine_chunks()
            return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(column), -1)

        found = links_within(several, read, lambda a, b: apart_matrix(a, b) <= limit, block)
        links = links.unionAll(found.select("a", "b"))
    return components(links)


def _name(folder: str, component: int, block: int) -> tuple:
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(folder)
    return store, base, f"{base}/{component}_{block}.arrow"


def _store(members: DataFrame, folder: str) -> DataFrame:
    """Write a file for each block, now: (component, block). A file is complete when it has its name."""

    @tidy
    def run(batches):
        done = []
        for t in by_unit(batches, 2):
            component, block = t["component"][0].as_py(), t["block"][0].as_py()
            store, base, name = _name(folder, component, block)
            store.create_dir(base)
            own = f"{base}/.{uuid.uuid4().hex}"
            with store.open_output_stream(own) as sink, pa.ipc.new_file(sink, t.schema) as writer:
                writer.write_table(t)
            try:
                store.move(own, name)
            except OSError:  # a task that ran before has left the same file, and the store does not replace it
                store.delete_file(own)
            done.append((component, block))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*done, strict=True)], names=["component", "block"])

    parts = parts_for(members.sparkSession, members.count(), TASK_MEMBERS)
    dealt = members.repartition(parts, "component", "block").sortWithinPartitions("component", "block")
    return materialize(dealt.mapInArrow(run, "component long, block long"), "block-names")


def _load(folder: str, component: int, block: int) -> pa.Table | None:
    store, _, name = _name(folder, component, block)
    try:
        with store.open_input_file(name) as source:
            return pa.ipc.open_file(source).read_all().combine_chunks()
    except FileNotFoundError:  # a hash may leave a block without members
        return None


def _pairs(node: np.ndarray, to: np.ndarray) -> np.ndarray:
    """The distinct rows (node, to) of different ids."""
    on = node != to
    return np.unique(np.stack([node[on], to[on]], axis=1), axis=0)


def _edges(found: list[np.ndarray]) -> pa.RecordBatch:
    both = np.unique(np.concatenate([np.zeros((0, 2), np.int64), *found]), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(both[:, i].copy(), pa.int64()) for i in (0, 1)] + [pa.nulls(len(both), pa.int64())], names=["a", "b", "n"])


def _counts(node: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    on = n > 0
    return pa.RecordBatch.from_arrays([pa.array(node[on], pa.int64()), pa.nulls(int(on.sum()), pa.int64()), pa.array(n[on], pa.int64())], names=["a", "b", "n"])


FOUND = "a long, b long, n long"


def links_within(members: DataFrame, read: Callable, near: Callable, block: int = BLOCK, count: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Links (a, b) that join what is near within each component, and, if asked for, rows (a, null, n)
    of how many copies are near to a, itself not among them.

    ``members`` has component, node, bytes and the columns that ``read`` makes
    an operand of from an Arrow table; ``near`` tells for two operands which
    pairs are near, as a matrix. ``copies`` is a column if links are counted.
    """
    members = materialize(members, "members")
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("_n"), F.sum("bytes").alias("_bytes"))
    cuts = F.greatest(F.ceil(F.col("_n") / block), F.ceil(F.col("_bytes") / block_bytes)).cast("long")
    sizes = materialize(sizes.where("_n > 1").select("component", F.least(cuts, "_n").alias("_cuts"), "_n"), "sizes")
    parts = parts_for(members.sparkSession, members.count(), TASK_MEMBERS)

    @tidy
    def whole(batches):
        for t in by_unit(batches, 1):
            ids, x = t["node"].to_numpy(), read(t)
            hits = near(x, x)
            np.fill_diagonal(hits, False)
            yield _edges([_pairs(ids, joined(hits, ids, ids)[0])])
            if count:
                yield _counts(ids, hits @ t["copies"].to_numpy())

    small = members.join(sizes.where("_cuts = 1").select("component"), "component", "left_semi")  # no component has many members
    found = materialize(small.repartition(parts, "component").sortWithinPartitions("component").mapInArrow(whole, FOUND), "links")
    large = sizes.where("_cuts > 1")
    if large.isEmpty():
        return found
    return found.unionByName(_large(join_hot(members, large, ["component"], "node", "_n").drop("_n"), read, near, block, count, block_bytes))


def _large(members: DataFrame, read: Callable, near: Callable, block: int, count: bool, block_bytes: int) -> DataFrame:
    """The same for components of several blocks; members have _cuts, the number of these."""
    spark, dealt = members.sparkSession, lambda rows: rows.repartition(parts_for(rows.sparkSession, rows.count(), 8), *rows.columns[:2]).sortWithinPartitions("component")
    first_folder, folder = fresh_path(spark, "first-blocks"), fresh_path(spark, "last-blocks")
    names = _store(members.withColumn("block", F.pmod(F.xxhash64("node"), F.col("_cuts"))).select("component", "block", "node", *[c for c in members.columns if c not in ("component", "node", "bytes", "_cuts")]), first_folder)
    # the least block that a hash has filled is the pivot
    pivots = names.groupBy("component").agg(F.min("block").alias("pivot"))

    @tidy
    def with_pivot(batches):
        known = pivot = None
        for component, b, p in (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)):
            t = _load(first_folder, component, b)
            ids, x = t["node"].to_numpy(), read(t)
            hits = near(x, x)
            out = [_pairs(ids, joined(hits, ids, ids)[0])]
            if b != p:
                if known != (component, p):
                    held = _load(first_folder, component, p)
                    known, pivot = (component, p), (held["node"].to_numpy(), read(held))
                to_a, to_b = joined(near(x, pivot[1]), ids, pivot[0])
                out += [_pairs(ids, to_a), _pairs(pivot[0], to_b)]
            yield _edges(out)

    links = materialize(dealt(names.join(pivots, "component").select("component", "block", "pivot")).mapInArrow(with_pivot, FOUND), "links")
    labels = components(links).select("node", F.col("component").alias("label"))
    named = materialize(members.drop("_cuts").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "labelled")
    per_label = named.groupBy("component", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    plan = per_label.groupBy("component").agg(F.max_by("label", F.struct("n", "label")).alias("major"), F.max(F.struct("n", "label", "bytes")).alias("m"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("labels"))
    cuts = lambda n, size: F.greatest(F.ceil(n / block), F.least(n, F.ceil(size / block_bytes))).cast("long")
    plan = plan.select("component", "major", cuts(F.col("n") - F.col("m.n"), F.col("bytes") - F.col("m.bytes")).alias("rest"), cuts(F.col("m.n"), F.col("m.bytes")).alias("own"), "labels", F.col("n").alias("_n"))
    plan = materialize(plan if count else plan.where("labels > 1"), "block-plan")
    if plan.isEmpty():
        return links
    again = join_hot(named, plan, ["component"], "node", "_n").withColumn("block", F.when(F.col("label") == F.col("major"), F.col("rest") + F.pmod(F.xxhash64("node"), F.col("own"))).otherwise(F.pmod(F.xxhash64("node"), F.greatest("rest", F.lit(1)))))
    _store(again.select("component", "block", "node", "label", *[c for c in members.columns if c not in ("component", "node", "bytes", "_cuts")]), folder)
    # blocks from 0 to rest - 1 have members of several labels, those from rest on of one
    every = plan.select("component", "rest", (F.col("rest") + F.col("own")).alias("all"))
    if count:
        units = every.select("component", F.explode(F.sequence(F.lit(0).cast("long"), F.col("all") - 1)).alias("block"), F.lit(0).cast("long").alias("begin"), F.col("all").alias("end"), "rest")
    else:
        units = every.select("component", "all", "rest", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rest") - 1)).alias("block"))
        units = units.select("component", "block", "all", "rest", F.explode(F.expr(f"sequence(0L, all - 1, {STRIP}L)")).alias("begin"))
        units = units.select("component", "block", "begin", F.least(F.col("begin") + STRIP, "all").alias("end"), "rest")

    @tidy
    def compare(batches):
        for component, b, begin, end, rest in (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)):
            t = _load(folder, component, b)
            if t is None:
                continue
            ids, own, x = t["node"].to_numpy(), t["label"].to_numpy(), read(t)
            n, out = np.zeros(len(ids), np.int64), []
            for j in range(begin, end):
                if not count and b < j < rest:  # the unit of the later one of two mixed blocks compares them
                    continue
                other = t if j == b else _load(folder, component, j)
                if other is None:
                    continue
                hits = near(x, x if j == b else read(other))
                if count:
                    hits &= ids[:, None] != other["node"].to_numpy()[None, :]
                    n += hits @ other["copies"].to_numpy()
                labels_ = other["label"].to_numpy()
                hits &= own[:, None] != labels_[None, :]
                if hits.any():
                    to_a, to_b = joined(hits, own, labels_)
                    out += [_pairs(own, to_a), _pairs(labels_, to_b)]
            yield _edges(out)
            if count:
                yield _counts(ids, n)

    return links.unionByName(materialize(dealt(units).mapInArrow(compare, FOUND), "links"))
