"""Helpers that several training-data operators share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Text bytes that one task should hold, and that one Python slice works on. The
#: whole-array steps need some 60 bytes for each of a slice; encoders need fewer
#: and gain from larger slices.
TASK_BYTES = 64 << 20
SLICE_BYTES = 2 << 20
ENCODE_BYTES = 3 << 20
#: A key is hot if it has over this part of all rows.
HOT = 1000
#: Rows of some 100 bytes that may go to every task, counted before.
SMALL_ROWS = 50_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a local master may go without that setting; it then gets a temporary
    folder, which is kept in the session for later calls.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='shared-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    This cuts the lineage: a lost executor costs a reread, not a recomputation.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts_for(spark: SparkSession, amount: float, per_task: float) -> int:
    """Partitions for an amount of work, never fewer than the session asks for."""
    return int(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-amount // per_task), 1))


def doc_rows(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text alone (a null text is empty), so no other column can clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


#: Stands for a null id where ids are ordered: it is the least one.
NO_ID = -(1 << 63)


def with_id(doc_id: Column) -> Column:
    return F.coalesce(doc_id, F.lit(NO_ID).cast("long"))


def without_id(doc_id: Column) -> Column:
    return F.when(doc_id != NO_ID, doc_id)


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id's decimal text, modulo ``by``: the folds of the contracts."""
    return F.crc32(doc_id.cast("string")) % F.lit(by)


def join_hot(rows: DataFrame, table: DataFrame, on: list[str], salt_by: str, copies: str, salts: int = 16, how: str = "inner", small: int = SMALL_ROWS) -> DataFrame:
    """Join with a table of distinct keys, of which ``copies`` says how many rows each has.

    A table of at most ``small`` rows goes to every task. Of a larger one, keys with over a ``HOT``-th of the rows, of which there are fewer than HOT
    (so their list may go to every task), are dealt to ``salts`` tasks each by a
    hash of another column.
    """
    total, n = table.agg(F.coalesce(F.sum(copies), F.lit(0)), F.count(F.lit(1))).first()
    if n <= small:
        return rows.join(F.broadcast(table), on, how)
    hot = F.broadcast(table.where(F.col(copies) * HOT > total).select(*on, F.lit(True).alias("_hot")))
    dealt = rows.join(hot, on, "left").withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(salt_by), F.lit(salts))).otherwise(0)).drop("_hot")
    last = F.when(F.col("_hot"), F.lit(salts - 1)).otherwise(0).cast("long")
    every = table.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), last))).drop("_hot")
    return dealt.join(every, [*on, "_salt"], how).drop("_salt")


def slices(batches, column: str = "text", most: int = SLICE_BYTES):
    """Cut Arrow record batches so that each holds about ``most`` bytes of text."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.binary_length(batch.column(batch.schema.get_field_index(column))).fill_null(0).to_numpy(zero_copy_only=False)
        held = start = 0
        for i, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start)


def release() -> None:
    """Give memory that is free back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # another C library
        pass


def tidy(run: Callable) -> Callable:
    """An Arrow function whose worker releases its memory after each task: workers live on
    through other stages, beside the JVM of their executor."""

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return tidied


def cuts_below(cuts: Column, value: Column, most: int) -> Column:
    """How many of at most ``most`` sorted cuts lie below a value, by halving."""
    ends = F.struct(F.lit(0).alias("lo"), F.array_size(cuts).alias("hi"))

    def step(at: Column, _: Column) -> Column:
        middle = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
        below = (at["lo"] < at["hi"]) & (F.get(cuts, middle) < value)
        return F.struct(F.when(below, middle + 1).otherwise(at["lo"]).alias("lo"), F.when(below, at["hi"]).otherwise(middle).alias("hi"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, most.bit_length()))), ends, step)["lo"]


#: Cuts of the ids that the driver holds; ranges beyond them are cut once more by a table.
COARSE = 1000


def id_ranges(docs: DataFrame, parts: int, coarse: int = COARSE) -> tuple[DataFrame, int]:
    """docs with part, and the number of parts: about ``parts`` even ranges of doc_id, in order.

    Ids are cut in two levels, so that neither the driver nor a row sees all
    cuts: the driver takes at most ``coarse`` of them, and each coarse range has
    a row of its own ones.
    """
    wide = min(parts, coarse)
    fine = -(-parts // wide)
    points = lambda n: F.array(*(F.lit(i / n) for i in range(1, n)))
    found = docs.agg(F.percentile_approx("doc_id", points(wide), F.lit(max(10_000, 20 * wide))).alias("c")).first()["c"] if wide > 1 else None
    ends = sorted(set(found or []))
    listed = F.array(*(F.lit(int(c)).cast("long") for c in ends)) if ends else F.array().cast("array<long>")
    place = cuts_below(listed, F.col("doc_id"), len(ends))
    if fine == 1:
        return docs.withColumn("part", place), len(ends) + 1
    own = docs.select("doc_id", place.alias("_wide")).groupBy("_wide").agg(F.array_sort(F.array_distinct(F.percentile_approx("doc_id", points(fine), F.lit(20 * fine)))).alias("_cuts"))
    rows = docs.withColumn("_wide", place).join(_sent(materialize(own, "id-cuts"), parts), "_wide")  # a row for each coarse range
    return rows.withColumn("part", F.col("_wide") * fine + cuts_below(F.col("_cuts"), F.col("doc_id"), fine)).drop("_wide", "_cuts"), (len(ends) + 1) * fine


def _sent(table: DataFrame, parts: int) -> DataFrame:
    """A table with some bytes for each part, sent to every task unless there are too many."""
    return F.broadcast(table) if parts <= 1_000_000 else table


def with_following(ranged: DataFrame, parts: int) -> DataFrame:
    """Adds following: for the greatest id of a range the number of the next range that has rows (after the last: the first), else null."""
    order = Window.orderBy("part")  # a row for each range
    ends = ranged.groupBy("part").agg(F.max("doc_id").alias("_end")).withColumn("following", F.coalesce(F.lead("part").over(order), F.first("part").over(order)))
    out = ranged.join(_sent(materialize(ends, "id-ends"), parts), "part")
    return out.withColumn("following", F.when(F.col("doc_id") == F.col("_end"), F.col("following"))).drop("_end")
