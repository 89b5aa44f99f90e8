"""Every query with SQL gives the rows that DuckDB gives on the same tables."""

import glob
import os

import duckdb
import pytest

from quillspark.plans import catalog

FOLDER = "/root/testdata/sf0.001"
TYPES = {("bigint", "BIGINT"), ("int", "INTEGER"), ("string", "VARCHAR"), ("double", "DOUBLE"), ("boolean", "BOOLEAN"), ("array<string>", "VARCHAR[]")}


def plain(v):
    return round(v, 6) if isinstance(v, float) else tuple(map(plain, v)) if isinstance(v, list) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in catalog.ORACLE_SQL:
        assert rows
        return
    found = duck.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    kinds = {d[0]: str(d[1]) for d in found.description}
    assert {(f.dataType.simpleString(), kinds[f.name]) for f in df.schema} <= TYPES
    expected = sorted((tuple(plain(dict(zip(names, r, strict=True))[c]) for c in columns) for r in found.fetchall()), key=repr)
    assert rows == expected
