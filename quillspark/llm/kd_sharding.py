"""K-d tree sharding: sizes near equal, by recursive weighted medians.

A node of the tree that stands for several shards is split along its widest
metadata dimension at the weighted median (of bytes), or at the quantile that
leaves each side its share when the number of shards is odd. All nodes of a
level are split together. A median is found without sorting: a grouped
histogram of keys gives the bin where the running bytes cross the target, and
further histograms of that bin alone refine it, until one key is left or the
bin holds almost nothing. The crossing bins are found by the executors; what
reaches the driver, and goes back to the tasks, is a row for each node, so it
is bounded by the number of shards and never depends on the rows.

The key of a dimension carries the dimension's value in its high bits, then
(for strings, of which only the first bytes after the table's common prefix
are ordered) a hash of the whole value, and a hash of text and id in its low
ones. So different values stay apart, and one value that holds a third of all rows
(a hot source) is cut where the bytes ask for it. The rows of one text all take the
metadata and the id of the least of them if they have at most ``TOGETHER`` of a
shard's bytes; so they have one key and one shard, and a shard is off by some parts
of that. A larger group is cut like any rows. Dimensions are the source,
the language, the length and the id; width is measured in parts of the whole
table's range, and ties go to the first.

Only DataFrame functions run here. The texts are read once, for their size and
checksum; all later passes are over a slim table in the shared folder.

Defined cases: a null text has no bytes, one of any length is a row; null
metadata counts as an empty string, a null id as the least one; other columns
are ignored; rows that repeat in full may fall on either side of a cut; an
empty table gives an empty result.
"""

from __future__ import annotations

import json
import os.path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import join_hot, materialize, parts_for

BINS = 1024
#: A cut is near enough if what it can still move is this part of a shard.
NEAR = 1 / 2000
#: Rows of one text that have at most this part of a shard's bytes stay in one shard.
TOGETHER = 1 / 20
SLOT_ROWS = 200_000
DIMENSIONS = ("d_source", "d_lang", "d_length", "d_id")
KEYS = [f"k_{d}" for d in DIMENSIONS]
#: Levels of the tree that are looked up anew in each pass before the rows are written with their nodes.
LEVELS = 6
#: Nodes whose table is sent to every task: some 50 bytes each.
SENT_NODES = 200_000


def _number(value: Column, skip: int) -> Column:
    """31 bits that order a string by the four bytes after the first ``skip``."""
    return (F.conv(F.rpad(F.substring(F.hex(F.encode(value, "utf-8")), 2 * skip + 1, 8), 8, "0"), 16, 10).cast("long") / 2).cast("long")


def slim(docs: DataFrame, size: Column) -> DataFrame:
    """What the passes need of each document: ids, size, checksum and its value in each dimension."""
    has = set(docs.columns)
    text = F.coalesce(F.col("text"), F.lit(""))
    string = lambda c: F.coalesce(F.col(c).cast("string") if c in has else F.lit(None).cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        size.cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
        string("source").alias("d_source"),
        string("lang").alias("d_lang"),
        F.length(text).cast("long").alias("d_length"),
    )
    return rows.withColumn("d_id", F.col("doc_id")).withColumn("tie_id", F.col("doc_id"))


def tied(rows: DataFrame, most_bytes: float) -> DataFrame:
    """Rows of slim, where those of one text that have at most so many bytes in all have the metadata and id of the least."""
    same, taken = ["text_hash", "size"], [*DIMENSIONS, "tie_id"]
    groups = rows.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", *taken)).alias("least")).where("n > 1")
    met = join_hot(rows, materialize(groups, "kd-groups"), same, "doc_id", "n", how="left")
    few = F.col("n") * F.col("size") <= most_bytes
    return met.select("doc_id", "size", "text_crc32", *[F.when(few, F.col(f"least.{c}")).otherwise(F.col(c)).alias(c) for c in taken])


def _keys(rows: DataFrame) -> DataFrame:
    """Add the root node and the keys: 30 bits of the value over the table's range, then 32 of text and id (for strings: 12 of them of the value)."""
    strings = {"d_source", "d_lang"}
    ends = rows.agg(*[f(d).alias(f"{d}{n}") for d in DIMENSIONS for f, n in ((F.min, 0), (F.max, 1))]).first()
    skip = {d: len(os.path.commonprefix([(ends[f"{d}{n}"] or "").encode() for n in (0, 1)])) for d in strings}
    rows = rows.withColumns({f"n_{d}": _number(F.col(d), skip[d]) if d in strings else F.col(d) for d in DIMENSIONS})
    ends = rows.agg(*[f(f"n_{d}").alias(f"{d}{n}") for d in DIMENSIONS for f, n in ((F.min, 0), (F.max, 1))]).first()
    of_text, of_id = F.shiftrightunsigned(F.col("text_crc32"), 12), F.xxhash64("tie_id")
    out = {}
    for d in DIMENSIONS:
        lo, hi = ends[f"{d}0"] or 0, ends[f"{d}1"] or 0
        part = (F.coalesce(F.col(f"n_{d}"), F.lit(lo)) - F.lit(lo)).cast("double") / F.lit(float(max(1, hi - lo)))
        if d in strings:
            tie = F.shiftleft(F.pmod(F.xxhash64(d), F.lit(1 << 12)), 20) + F.shiftleft(F.shiftrightunsigned(of_text, 4), 4) + F.pmod(of_id, F.lit(1 << 4))
        else:
            tie = F.shiftleft(of_text, 12) + F.pmod(of_id, F.lit(1 << 12))
        out[f"k_{d}"] = F.shiftleft((part * ((1 << 30) - 1)).cast("long"), 32) + tie
    return rows.select("doc_id", "size", "text_crc32", *[c.alias(k) for k, c in out.items()], F.lit(0).alias("node"))


def _looked_up(rows: DataFrame, table: list[tuple], schema: str, how: str = "inner") -> DataFrame:
    """Rows joined with a table by node, sent to the tasks if it is small."""
    schema = f"node int, {schema}"
    names = [part.split()[0] for part in schema.split(", ")]
    text = json.dumps([dict(zip(names, row, strict=True)) for row in table])
    made = rows.sparkSession.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{schema}>>")))
    return rows.join(F.broadcast(made) if len(table) <= SENT_NODES else made, "node", how)


def _cuts(at: DataFrame, shards: dict[int, int], shard_bytes: float, near: float) -> dict[int, tuple[int, int]]:
    """The place of the key and the cut for every node of more than one shard (rows up to the cut go left)."""
    ends = at.groupBy("node").agg(F.sum("size").alias("w"), *[f(k).alias(f"{k}{n}") for k in KEYS for f, n in ((F.min, 0), (F.max, 1))])
    cuts, state = {n: (0, -1) for n, s in shards.items() if s > 1}, {}
    for r in ends.collect():  # a row for each node
        if r["node"] in cuts:
            dim = max(range(len(KEYS)), key=lambda i: ((r[f"{KEYS[i]}1"] >> 32) - (r[f"{KEYS[i]}0"] >> 32), -i))
            s = shards[r["node"]]
            state[r["node"]] = dim, r[f"{KEYS[dim]}0"], r[f"{KEYS[dim]}1"], r["w"] * (s // 2) / s
    while state:
        table = [(n, dim, lo, max(1, -(-(hi - lo + 1) // BINS)), hi, float(need)) for n, (dim, lo, hi, need) in state.items()]
        key = F.element_at(F.array(*KEYS), F.col("dim") + 1)
        here = _looked_up(at.select("node", "size", *KEYS), table, "dim int, lo long, step long, hi long, need double").withColumn("k", key).where("k between lo and hi")
        bins = here.groupBy("node", F.floor((F.col("k") - F.col("lo")) / F.col("step")).alias("b")).agg(F.sum("size").alias("w"), F.min("k").alias("lo"), F.max("k").alias("hi"), F.first("need").alias("need"))
        upto = bins.withColumn("upto", F.sum("w").over(Window.partitionBy("node").orderBy("b"))).withColumn("on", (F.col("upto") < F.col("need")).cast("int"))  # at most BINS rows a node
        order = F.struct("on", F.when(F.col("on") == 0, F.col("b")).otherwise(-F.col("b")))  # the first that reaches the target, else the last
        found = upto.groupBy("node").agg(F.min_by(F.struct("w", "lo", "hi", (F.col("need") - F.col("upto") + F.col("w")).alias("left")), order).alias("x"))
        for r in found.collect():  # a row for each node
            n, x = r["node"], r["x"]
            dim = state[n][0]
            if x["lo"] == x["hi"] or x["w"] <= near * shard_bytes:
                cuts[n] = dim, (x["hi"] if abs(x["w"] - x["left"]) <= abs(x["left"]) else x["lo"] - 1)
                del state[n]
            else:
                state[n] = dim, x["lo"], x["hi"], x["left"]
    return cuts


def _dealt(rows: DataFrame, shards: int, shard_bytes: float, near: float) -> DataFrame:
    """Add the shard of each row, a level of the tree at a time."""
    nodes, first, at, level = {0: shards}, {0: 0}, rows, 0
    while any(s > 1 for s in nodes.values()):
        table, below = [], {}
        for n, (dim, cut) in _cuts(at, nodes, shard_bytes, near).items():
            left, half = max(first) + 1, nodes[n] // 2
            below[left], below[left + 1] = half, nodes[n] - half
            first[left], first[left + 1] = first[n], first[n] + half
            table.append((n, dim, cut, left))
        nodes = {n: s for n, s in nodes.items() if s == 1} | below
        key = F.element_at(F.array(*KEYS), F.col("dim") + 1)
        to = F.when(F.col("dim").isNull(), F.col("node")).when(key <= F.col("cut"), F.col("left")).otherwise(F.col("left") + 1)
        at = _looked_up(at, table, "dim int, cut long, left int", "left").select("doc_id", "size", "text_crc32", *KEYS, to.alias("node"))
        level += 1
        if level % LEVELS == 0:
            at = materialize(at, "kd-nodes")
    return _looked_up(at, [(n, first[n]) for n in nodes], "shard int").select("doc_id", "size", "text_crc32", "shard")


def number_rows(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Gapless numbers from 0 within each group, however large: groups are dealt to
    buckets by a hash of the id, and each bucket starts where those before it end."""
    buckets = parts_for(rows.sparkSession, rows.count(), SLOT_ROWS)
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)))
    counts = rows.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(group, "_bucket").orderBy(*order)
    numbered = rows.withColumn("_row", F.row_number().over(within))
    return numbered.join(starts, [group, "_bucket"]).withColumn(name, (F.col("_start") + F.col("_row") - 1).cast("long")).drop("_bucket", "_start", "_row")


def shard(docs: DataFrame, shards: int = 0, target_bytes: int = 0, near: float = NEAR, together: float = TOGETHER) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot: near-equal bytes in each shard.

    Give the number of shards, or the bytes that a leaf should have. ``near``
    is the part of a shard that a cut may leave on the wrong side (0: none),
    ``together`` the part of a shard up to which equal texts are not parted.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 8
    rows = materialize(slim(docs, size), "kd-slim")
    total = rows.agg(F.sum("size")).first()[0] or 0
    shards = shards or max(1, -(-total // max(1, target_bytes)))
    rows = materialize(_keys(materialize(tied(rows, together * total / shards), "kd-tied") if together else rows), "kd-keys")
    dealt = _dealt(rows, shards if total else 1, total / shards, near)
    return number_rows(dealt, "shard", ["doc_id", "text_crc32"], "slot")
