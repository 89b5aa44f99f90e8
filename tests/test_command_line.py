"""Settings, logs, clients over a stood-in transport, and the command line on small tables."""

import json
import logging
from pathlib import Path

import pytest

from quillspark import __main__ as command
from quillspark import config, logs
from quillspark.operators import batching, clients
from quillspark.plans import profile

PROFILES = Path(profile.__file__).parents[1] / "profiles"


def said(capsys) -> dict:
    return json.loads(capsys.readouterr().out.strip().splitlines()[-1])


@pytest.mark.parametrize("path", sorted(PROFILES.glob("*.json")), ids=lambda p: p.stem)
def test_shipped_profiles(path):
    assert profile.load(str(path))["name"] == path.stem
    assert {d["profile"] for d in profile.datasets(str(PROFILES))} == {p.name for p in PROFILES.glob("*.json")}


def test_job_key():
    p = profile.load(str(PROFILES / "general.json"))
    service = {"deployment": "d", "api_base": "https://x/"}
    assert profile.job_key(p, service, None) == profile.job_key(p, service | {"api_base": "https://x"}, None) != profile.job_key(p, service, 5)


def test_settings(tmp_path, monkeypatch):
    path = tmp_path / "c.ini"
    path.write_text("[spark]\nspark.sql.shuffle.partitions = 7\n[store]\nendpoint = http://s\naccess_key = a\nsecret_key = ${SECRET}\n[embedding]\nurl = u\n")
    monkeypatch.setenv("SECRET", "s3")
    got = config.load(str(path))
    assert got.spark == {"spark.sql.shuffle.partitions": "7", "spark.hadoop.fs.s3a.endpoint": "http://s", "spark.hadoop.fs.s3a.access.key": "a", "spark.hadoop.fs.s3a.secret.key": "s3"} and got.embedding == {"url": "u"}
    path.write_text("[store]\naccess_key = a\n")
    with pytest.raises(ValueError):
        config.load(str(path))
    assert config.load(None) == config.Settings()


def test_warnings_are_json_lines(spark, tmp_path):
    log = logs.set_up(str(tmp_path / "t.log"), str(tmp_path / "j.log"))
    log.info("fine")
    log.warning("page failed", extra={"doc_id": "d", "page": 3})
    logs.set_up()
    assert "fine" in (tmp_path / "t.log").read_text()
    rows = spark.read.schema(logs.TABLE).json(f"file://{tmp_path}/j.log").collect()
    assert [(r["level"], r["doc_id"], r["page"], r["message"]) for r in rows] == [("WARNING", "d", "3", "page failed")]
    logging.getLogger("quillspark").handlers.clear()


def client(status, body, headers=None, seen=None):
    def transport(url, headers_, data, timeout):
        if seen is not None:
            seen.append(json.loads(data))
        return status, headers or {}, json.dumps(body).encode() if not isinstance(body, bytes) else body

    return clients.Client("http://x", transport=transport)


def test_embeddings_come_in_the_order_of_the_inputs():
    seen = []
    got = clients.HttpEmbedder(client(200, {"data": [{"index": 1, "embedding": [0, 2]}, {"index": 0, "embedding": [1, 0]}]}, seen=seen), "m", 2)(["a", "b"])
    assert got == [[1, 0], [0, 2]] and seen == [{"model": "m", "input": ["a", "b"], "dimensions": 2}]
    for data in ([{"index": 0, "embedding": [1, 0]}], [{"index": 0, "embedding": [0, 0]}, {"index": 1, "embedding": [1, 0]}], [{"index": 0, "embedding": [1]}, {"index": 1, "embedding": [1, 0]}]):
        with pytest.raises(batching.ProviderError):
            clients.HttpEmbedder(client(200, {"data": data}), "m", 2)(["a", "b"])


@pytest.mark.parametrize("status,body,fatal,delay", [(401, {}, True, None), (400, {"error": {"param": "dimensions"}}, True, None), (400, {"error": {"code": "bad_text"}}, False, 2.0), (429, {}, False, 4.0), (500, b"oops", False, 2.0)])
def test_failures_of_a_service(status, body, fatal, delay):
    with pytest.raises(batching.ProviderError) as e:
        client(status, body, {"Retry-After": "4"} if status == 429 else {}).ask({})
    assert isinstance(e.value, batching.FatalProviderError) == fatal and e.value.status == status and (fatal or e.value.delay == delay)


def test_chat_and_limits():
    assert clients.HttpChat(client(200, {"choices": [{"message": {"content": "hi"}}]}), "m")([]) == "hi"
    with pytest.raises(batching.ProviderError):
        clients.HttpChat(client(200, {"choices": []}), "m")([])
    assert clients.limits(client(200, {}, {"X-RateLimit-Limit-Tokens": "1000", "Date": "x"}), "m") == {"x-ratelimit-limit-tokens": "1000"}


def test_ingest_of_a_folder_and_of_a_file(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("words of a " * 40)
    (tmp_path / "in/b.txt").write_text("words of b " * 40 + "\f" + "second page " * 30)
    (tmp_path / "in/c.txt").write_text("")
    tables = ["--log", f"file://{tmp_path}/log", "--chunks", f"file://{tmp_path}/chunks", "--extension", ".txt"]
    assert command.main(["ingest", "--root", f"file://{tmp_path}/in", *tables, "--dry-run"]) == 0
    assert said(capsys)["to_process"] == 2
    assert command.main(["ingest", "--root", f"file://{tmp_path}/in", *tables]) == 0
    assert said(capsys) == {"SUCCESS": 2}
    (tmp_path / "in/a.txt").write_text("other words of a " * 40)
    assert command.main(["ingest", "--file", f"file://{tmp_path}/in/a.txt", *tables]) == 0
    chunks = spark.read.parquet(f"file://{tmp_path}/chunks").collect()
    assert sorted(r["file_name"] for r in chunks) == ["a.txt", "b.txt"] and any("other words" in r["chunk_text"] for r in chunks)
    capsys.readouterr()
    assert command.main(["ingest", "--file", f"file://{tmp_path}/in/a.txt", *tables, "--dry-run"]) == 0
    assert said(capsys)["to_process"] == 0
    assert command.main(["ingest", "--file", f"file://{tmp_path}/in/a.txt", *tables, "--force"]) == 0
    assert command.main(["stats", "--log", f"file://{tmp_path}/log"]) == 0
    assert said(capsys) == {"SUCCESS": 2}


def test_rechunk_and_backfill(spark, tmp_path, capsys):
    spark.createDataFrame([("d", 1, "Title: Alpha\nbody " * 30), ("e", 1, "more " * 50)], "doc_id string, page int, text string").write.parquet(f"file://{tmp_path}/text")
    general = str(PROFILES / "general.json")
    assert command.main(["rechunk", "--table", f"file://{tmp_path}/text", "--profile", general, "--set", "chunking.max_tokens=60", "--set", "chunking.min_tokens=10", "--set", "chunking.overlap_tokens=5", "--out", f"file://{tmp_path}/chunks"]) == 0
    n = said(capsys)["chunks"]
    table = f"file://{tmp_path}/rows"
    spark.read.parquet(f"file://{tmp_path}/chunks").selectExpr("chunk_id", "chunk_text", "cast(null as array<float>) chunk_vector").write.parquet(table)
    run = ["backfill", "--table", table, "--profile", general, "--set", "embedding.dimensions=64", "--set", "embedding.rpm=60000", "--embedder", "quillspark.operators.providers:HashEmbedder"]
    assert command.main([*run, "--dry-run"]) == 0 and said(capsys) == {"eligible": n}
    with pytest.raises(SystemExit):
        command.main(run)
    assert command.main([*run, "--yes", "--out", f"file://{tmp_path}/out"]) == 0
    assert said(capsys) == {"SUCCESS": n}


def test_query(spark, capsys):
    assert command.main(["query", "status_health", "--data", "/root/testdata/sf0.001"]) == 0
    assert "SUCCESS" in capsys.readouterr().out
