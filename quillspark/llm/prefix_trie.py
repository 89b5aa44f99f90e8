"""A trie of the prefixes that conversations share, from chained digests.

Each turn is reduced to a SHA-256 of its role and text in Spark itself. Along a
conversation the digests are chained, each prefix's from the one before and
its last turn's, so equal sequences of turns, and only these, have equal
digests. Every prefix is a row of its own, and a node of the trie is a group of
rows with one depth and digest: its members are the conversations that start
with it, and the least of them names it.

Sums over subtrees come by exploding nodes to all their ancestors. A
conversation that is the least member of a node is so of all deeper ones on
its path as well, so the nodes that it names are the end of its path, each
node is named by one conversation, and a node's subtree is named by its
members. So nodes are first summed along the conversation that names them;
what is left to explode is a row for each prefix, not for each pair of a node
and an ancestor, and grouping adds those partly before the shuffle.

Only digests, numbers and counts are shuffled, texts are not. A chain is
sequential, so the digests of one conversation pass through one task, one after
the other; it holds one of them at a time. Ids of the conversations that end at
a node are packed by ranges of ids before they meet, and are hashed as a stream.

Defined cases: turns are ordered by number, null first; repeated numbers are
ordered by their turns' digests, repeated rows all stay; a null role or text is empty; an
empty text is a turn without words; rows without a conv_id belong to no
conversation and are left out; texts of any length are hashed whole; other
columns are ignored; an empty table gives an empty result, without a root.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import join_hot, materialize, remainder, tidy

WORD = r"[^\x20\x09-\x0D]+"
ROOT = hashlib.sha256(b"").digest()
#: Bits of an id within a packed row: at most 16384 ids meet in one.
PACKED_BITS = 14


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), turn_digest and words of every turn of a conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    turns = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("turn_digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "turn_digest")
    return turns.select("conv_id", F.row_number().over(order).cast("long").alias("place"), "turn_digest", "words")


def with_openings(turns: DataFrame, period: int, kinds: int) -> DataFrame:
    """conv_id, step, place, turn_digest and words of conversations that open as others do.

    A conversation's first h turns give way to the first h of the conversation
    ``conv_id - conv_id % period`` (all if it has fewer, none if it is not
    there), h = crc32(conv_id) % ``kinds``. Each conversation has a row with
    step -1, also one without turns.
    """
    base, taken = F.col("conv_id") - F.col("conv_id") % period, remainder(F.col("conv_id"), kinds)
    first = turns.where("place = 1").select("conv_id", base.alias("base"), taken.alias("taken"))
    heads = turns.where((F.col("place") < kinds) & (F.col("conv_id") % period == 0)).withColumnRenamed("conv_id", "base")
    # at most kinds - 1 turns of a base and period conversations meet
    opened = first.where("base <> conv_id and taken > 0").join(heads, "base").where("place <= taken")
    own = turns.where((base == F.col("conv_id")) | (F.col("place") > taken))
    columns = lambda df, step: df.select("conv_id", F.lit(step).alias("step"), "place", "turn_digest", "words")
    marks = first.select("conv_id", F.lit(0).cast("long").alias("place"), F.lit(None).cast("binary").alias("turn_digest"), F.lit(0).cast("long").alias("words"))
    return columns(marks, -1).unionAll(columns(opened, 0)).unionAll(columns(own, 1))


def as_they_are(turns: DataFrame) -> DataFrame:
    """The same columns for conversations as they are."""
    mark = turns.where("place = 1").select("conv_id", F.lit(-1).alias("step"), F.lit(0).cast("long").alias("place"), F.lit(None).cast("binary").alias("turn_digest"), F.lit(0).cast("long").alias("words"))
    return mark.unionAll(turns.select("conv_id", F.lit(1).alias("step"), "place", "turn_digest", "words"))


def prefixes(steps: DataFrame) -> DataFrame:
    """conv_id, depth, digest, words (of the last turn) and ends (0 or 1) for every prefix, the empty one included."""

    @tidy
    def chain(batches):
        conv = state = None
        depth = 0
        held: list[list] = [[], [], [], []]  # the row that may be the last of its conversation

        def rows(out: list[list], ends: list[int]) -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip([*out, ends], types, strict=True)], names=["conv_id", "depth", "digest", "words", "ends"])

        for batch in batches:
            if not batch.num_rows:
                continue
            out, sha = held, hashlib.sha256
            convs, depths, digests, words = out
            for c, turn, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if turn is None:
                    conv, state, depth = c, ROOT, 0
                else:
                    state, depth = sha(state + turn).digest(), depth + 1
                convs.append(conv)
                depths.append(depth)
                digests.append(state)
                words.append(n)
            ends = [int(d == 0) for d in depths[1:]]
            yield rows([x[:-1] for x in out], ends)
            held = [x[-1:] for x in out]
        if held[0]:
            yield rows(held, [1])

    dealt = steps.repartition("conv_id").sortWithinPartitions("conv_id", "step", "place")
    return dealt.select("conv_id", "turn_digest", "words").mapInArrow(chain, "conv_id long, depth long, digest binary, words long, ends int")


def _ends(ended: DataFrame) -> DataFrame:
    """depth, digest and ends_sha256: of the ids that end at a node, ascending, with commas."""
    part = F.shiftright("conv_id", PACKED_BITS).alias("part")
    packed = ended.groupBy("depth", "digest", part).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))

    @tidy
    def hashed(batches):
        node = state = None
        for batch in batches:
            out: list[list] = [[], [], []]
            for d, digest, ids in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if (d, digest) == node:
                    state.update(b",")
                else:
                    if node is not None:
                        for x, v in zip(out, (*node, state.hexdigest()), strict=True):
                            x.append(v)
                    node, state = (d, digest), hashlib.sha256()
                state.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.string())], names=["depth", "digest", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.binary()), pa.array([state.hexdigest()])], names=["depth", "digest", "ends_sha256"])

    dealt = packed.repartition("depth", "digest").sortWithinPartitions("depth", "digest", "part")
    return dealt.select("depth", "digest", "ids").mapInArrow(hashed, "depth long, digest binary, ends_sha256 string")


def trie(steps: DataFrame) -> DataFrame:
    """A row for each node: conv_id (its least member), depth, parent_conv_id, n_convs, n_children,
    n_leaves and saved_tokens of its subtree, ends_sha256, and digest."""
    node = ["depth", "digest"]
    paths = materialize(prefixes(steps), "prefixes")
    nodes = materialize(paths.groupBy(*node).agg(F.min("conv_id").alias("least"), F.count(F.lit(1)).alias("n_convs"), F.sum("ends").alias("n_ends")), "nodes")
    # most prefixes belong to one conversation alone: what is joined are the others
    known = join_hot(paths, nodes.where("n_convs > 1"), node, "conv_id", "n_convs", how="left")
    names = F.coalesce(F.col("least"), F.col("conv_id")) == F.col("conv_id")
    others = F.coalesce(F.col("n_convs") - 1, F.lit(0).cast("long"))
    childless = F.when(F.coalesce(F.col("n_ends"), F.col("ends")) == F.coalesce(F.col("n_convs"), F.lit(1)), 1).otherwise(0)
    upward = Window.partitionBy("conv_id").orderBy(F.col("depth").desc())
    below = upward.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = lambda x: F.sum(F.when(names, x).otherwise(0)).over(below)
    lifted = known.select(*node, "conv_id", F.col("ends"), names.alias("names"), F.lead(F.coalesce("least", "conv_id")).over(upward).alias("parent"), F.lead("digest").over(upward).alias("parent_digest"), summed(others * F.col("words")).alias("saved"), summed(childless).alias("leaves"))
    lifted = materialize(lifted, "lifted")
    own = F.col("names")
    sums = lifted.groupBy(*node).agg(F.min("conv_id").alias("conv_id"), F.max(F.when(own, F.col("parent"))).alias("parent_conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    children = lifted.where(own & F.col("parent_digest").isNotNull()).groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_digest").alias("digest")).agg(F.count(F.lit(1)).alias("n_children"))
    ends = _ends(lifted.where("ends = 1"))
    out = sums.join(children, node, "left").join(ends, node, "left")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"), "digest")


def saved_share(nodes: DataFrame) -> Column:
    """Tokens that a cache of shared prefixes saves, at the root: its saved_tokens."""
    return F.max(F.when(F.col("depth") == 0, F.col("saved_tokens")))
