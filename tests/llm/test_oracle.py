"""The operators that SQL can state give the rows that DuckDB gives, on all rows of the smallest tables."""

import glob
import os

import duckdb
import pytest

pytest.importorskip("public_tokenizers")
from quillspark.llm import queries  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = queries.QUERIES[name](spark, FOLDER)
    found = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    wanted = [dict(zip(names, r, strict=True)) for r in found.fetchall()]
    key = lambda r: sorted(r.items(), key=lambda x: x[0]).__repr__()
    assert sorted(map(key, (r.asDict() for r in df.collect()))) == sorted(map(key, wanted))
