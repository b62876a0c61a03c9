"""Every registered query that has SQL, against DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    return float(f"{v:.9g}") if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    want = sorted(str([plain(r[names.index(c)]) for c in columns]) for r in cursor.fetchall())
    got = sorted(str([plain(r[c]) for c in columns]) for r in frame.collect())
    assert got == want


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
