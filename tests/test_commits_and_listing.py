"""Commits that are all or nothing, rows that cannot be written, and listings by prefixes."""

import time

import pytest
from pyspark.sql import functions as F

from quillspark import schema, session
from quillspark.operators import ledger
from quillspark.sources import files
from quillspark.sources.commits import Tables, write_isolating
from quillspark.sources.listing import store_listing

SCHEMAS = {"chunks": "doc_id string, chunk_id string, profile_hash string, source_hash string", "results": "doc_id string, profile_hash string, source_hash string, chunk_count int, updated_at timestamp"}


def chunks(spark, doc, n, source="s1"):
    return spark.createDataFrame([(doc, f"{doc}-{source}-{i}", source) for i in range(n)], "doc_id string, chunk_id string, source_hash string")


def ids(tables):
    return sorted(r["chunk_id"] for r in tables.read("chunks").collect())


def test_two_tables_change_together_or_not(spark, tmp_path, monkeypatch):
    tables = Tables(spark, f"file://{tmp_path}/t", SCHEMAS)
    now = F.lit("2024-01-01").cast("timestamp")
    assert tables.read("chunks").collect() == [] and tables.state().number == 0
    assert tables.save_profile_result(chunks(spark, "a", 3), "p", now, "w", 0)
    assert tables.save_profile_result(chunks(spark, "b", 1), "p", now, "w", 1)
    held = ids(tables)
    with monkeypatch.context() as m:  # the run is killed when the data are written and the commit is not
        m.setattr(Tables, "_create", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            tables.save_profile_result(chunks(spark, "a", 1, "s2"), "p", now, "w", 2)
    assert ids(tables) == held and {r["doc_id"]: r["chunk_count"] for r in tables.read("results").collect()} == {"a": 3, "b": 1}
    assert tables.save_profile_result(chunks(spark, "a", 2, "s2"), "p", now, "w", 2)
    after = ids(tables)
    assert after == ["a-s2-0", "a-s2-1", "b-s1-0"]
    assert not tables.save_profile_result(chunks(spark, "a", 9, "s3"), "p", now, "w", 2)  # the batch is sent again
    assert ids(tables) == after and {(r["doc_id"], r["source_hash"], r["chunk_count"]) for r in tables.read("results").collect()} == {("a", "s2", 2), ("b", "s1", 1)}
    assert tables.vacuum(keep=1) > 0 and ids(tables) == after and tables.vacuum(keep=1) == 0


def test_a_writer_that_comes_second_starts_from_the_newer_state(spark, tmp_path):
    tables = Tables(spark, f"file://{tmp_path}/t", {"n": "n long"})
    seen = []

    def change(state):
        seen.append(state.number)
        if len(seen) == 1:
            assert tables.append("n", spark.range(5).select(F.col("id").alias("n")))  # another one is first
        return {"n": ("replace", tables.read("n", state).where("n < 3").unionByName(spark.createDataFrame([(70,)], "n long")))}

    assert tables.commit(change) and seen == [0, 1]
    assert sorted(r["n"] for r in tables.read("n").collect()) == [0, 1, 2, 70]
    with pytest.raises(RuntimeError):
        tables.commit(lambda s: tables.append("n", spark.range(1).select(F.col("id").alias("n"))) and {"n": ("append", tables.read("n", s))}, attempts=2)


def test_batches_of_a_stream_come_once(spark, tmp_path):
    source, tables = f"file://{tmp_path}/in", Tables(spark, f"file://{tmp_path}/t", {"n": "id long"})
    spark.range(20).write.parquet(source)
    add = tables.foreach_append("n", "stream")
    for checkpoint in ("one", "two"):  # with its offsets lost, the stream sends batch 0 again
        spark.readStream.schema("id long").parquet(source).writeStream.foreachBatch(add).option("checkpointLocation", f"file://{tmp_path}/{checkpoint}").trigger(availableNow=True).start().awaitTermination()
    assert tables.read("n").count() == 20


@pytest.mark.parametrize("kind", ["long", "string"])
def test_rows_that_cannot_be_written_stand_alone(spark, tmp_path, kind):
    rows = spark.range(1000).select(F.format_string("k%04d", "id").alias("k") if kind == "string" else F.col("id").alias("k"), F.when(F.col("id").isin(0, 417, 999), 0).otherwise(1).alias("v"))
    tables = Tables(spark, f"file://{tmp_path}/t", {"t": f"k {kind}, v double"})
    refuse = lambda part: tables.append("t", part.withColumn("v", F.when(F.col("v") == 0, F.raise_error(F.lit("poison"))).otherwise(F.col("v").cast("double"))))
    bad = write_isolating(rows, "k", refuse)
    assert bad == ([0, 417, 999] if kind == "long" else ["k0000", "k0417", "k0999"]) and tables.read("t").count() == 997
    assert write_isolating(rows.limit(0), "k", refuse) == []


def test_what_passes_by_itself_is_tried_again(spark):
    tries = []

    def write(part):
        tries.append(1)
        if len(tries) < 3:
            raise OSError("locked")

    assert write_isolating(spark.range(3), "id", write, wait=lambda s: None) == [] and len(tries) == 3


def test_a_store_is_listed_by_prefixes(spark, tmp_path):
    root = tmp_path / "bucket"
    for name in ("top.pdf", "a/1.pdf", "a/x/2.PDF", "a/x/note.txt", "b/3.pdf", "c/d/e/4.pdf"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(name.encode())
    listing = store_listing(spark, f"file://{root}")
    assert {(r["bucket"], r["key"], r["size"]) for r in listing.collect()} == {("bucket", n, len(n)) for n in ("top.pdf", "a/1.pdf", "a/x/2.PDF", "a/x/note.txt", "b/3.pdf", "c/d/e/4.pdf")}
    assert listing.rdd.getNumPartitions() == 4  # the root's own objects, and a task for each folder
    assert store_listing(spark, f"file://{root}", depth=2).count() == 6
    got = files.from_listing(listing).collect()
    assert {r["file_path"] for r in got} == {f"s3://bucket/{n}" for n in ("top.pdf", "a/1.pdf", "a/x/2.PDF", "b/3.pdf", "c/d/e/4.pdf")} and all('"' not in r["file_hash"] for r in got)


def test_locks_are_taken_and_released(spark):
    now = F.lit("2024-01-01 12:00:00").cast("timestamp")
    docs = lambda *names: spark.createDataFrame([(n,) for n in names], "doc_id string")
    locks = ledger.take_locks(spark.createDataFrame([], schema.LOCKS), docs("a", "b", "b"), "me", now, 60)
    later = now + F.expr("interval 30 seconds")
    locks = ledger.take_locks(locks, docs("b", "c"), "you", later, 60)
    assert {r["doc_id"]: r["owner"] for r in locks.collect()} == {"a": "me", "b": "me", "c": "you"}
    over = now + F.expr("interval 60 seconds")
    taken = ledger.take_locks(locks, docs("a", "c"), "you", over, 60)
    assert {r["doc_id"]: (r["owner"], r["until"].second) for r in taken.collect()} == {"a": ("you", 0), "b": ("me", 0), "c": ("you", 0)}
    assert {r["doc_id"] for r in ledger.unlocked(docs("a", "b", "c"), locks, "you", later).collect()} == {"c"}
    assert {r["doc_id"] for r in ledger.release_locks(taken, "you", docs("a")).collect()} == {"b", "c"} and ledger.release_locks(taken, "you").count() == 1


def test_runs_of_one_deployment_have_one_quota(spark):
    now = F.lit("2024-01-01").cast("timestamp")
    runs = ledger.register_run(spark.createDataFrame([], schema.RUNS), "j1", "d", 30, 1000, now, "general", "t")
    runs = ledger.register_run(runs, "j2", "d", 30, 1000, now)
    again = ledger.register_run(runs, "j1", "e", 60, 5, now).collect()
    assert {(r["job_key"], r["deployment_key"], r["rpm"], r["profile_name"]) for r in again} == {("j1", "e", 60.0, "general"), ("j2", "d", 30.0, None)}
    with pytest.raises(ValueError, match="other limits in job j"):
        ledger.register_run(runs, "j3", "d", 31, 1000, now)


def test_files_are_decided_by_hash_where_times_do_not_count(spark):
    at = "2024-01-01 00:00:00"
    found = spark.createDataFrame([("same", "h", 5), ("changed", "new", 5)], "doc_id string, file_hash string, file_size long").withColumn("last_modified", F.lit(at).cast("timestamp")).withColumn("readable", F.lit(True)).withColumn("file_path", F.col("doc_id"))
    log = spark.createDataFrame([("same", "SUCCESS", 0, "h"), ("changed", "SUCCESS", 0, "old")], "doc_id string, status string, retry_count int, file_hash string").withColumn("last_modified", F.lit(at).cast("timestamp"))
    decided = lambda **o: {r["doc_id"]: r["should_process"] for r in ledger.decide(found, log, **o).collect()}
    assert decided() == {"same": False, "changed": False}  # its time alone says that it is the same
    assert decided(match_times=False) == {"same": False, "changed": True}


def test_reads_end_in_time(spark):
    slow = spark.range(1, numPartitions=1).select(F.udf(lambda x: time.sleep(20))("id"))
    start = time.time()
    with pytest.raises(TimeoutError):
        session.within(spark, 1.0, slow.collect)
    assert time.time() - start < 15
    assert session.within(spark, 30.0, spark.range(5).count) == 5 and not spark.sparkContext.getJobTags()


def test_aged_results():
    now, reads = [0.0], []

    def read():
        reads.append(now[0])
        if now[0] == 25:
            raise RuntimeError("down")
        return len(reads)

    held = session.Aged(10, lambda: now[0])
    seen = []
    for t in (0, 5, 12, 25, 30):
        now[0] = float(t)
        seen.append(held.get("k", read))
    assert seen == [(1, 0.0), (1, 5.0), (2, 0.0), (2, 13.0), (4, 0.0)]
    with pytest.raises(RuntimeError):
        now[0] = 25.0
        session.Aged(10, lambda: now[0]).get("other", read)
