"""Every bound query against its SQL twin in DuckDB on the smallest tables."""

import glob
import os
from pathlib import Path

import pytest

import __spark_entry__ as entry
from bindings import star, star_sql

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if value is None or value != value:
        return ""
    if isinstance(value, float):
        return f"{value:.6f}"
    return str(value)


def table(names, data):
    at = [names.index(n) for n in sorted(names)]
    return sorted(tuple(plain(r[i]) for i in at) for r in data)


@pytest.mark.parametrize("name", sorted(star.QUERIES))
def test_query_matches_its_sql(spark, duck, name):
    got = entry.queries()[name](spark, FOLDER)
    data = [tuple(r) for r in got.collect()]
    assert data
    sql = entry.oracle_sql().get(name)
    if sql is not None:
        result = duck.execute(sql)
        names = [c[0] for c in result.description]
        assert sorted(names) == sorted(got.columns)
        assert table(got.columns, data) == table(names, result.fetchall())


def test_every_query_has_its_sql():
    assert set(star_sql.ORACLES) == set(star.QUERIES) - {"pq_topk"}  # approximate; compared with the exact search
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(star.QUERIES) <= set(entry.queries())


def test_flagship(spark):
    got = entry.entry(spark)
    assert got.columns == ["query_id", "rank", "node_id", "score", "part_no", "context", "prompt"] and got.count() == 50
