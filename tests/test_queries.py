"""Every query over the smallest tables, against its SQL in DuckDB where it has one."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tools.compare import plain

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables here")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for p in SF.glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, str(SF))
    cols = sorted(df.columns)
    rows = Counter(tuple(plain(r[c]) for c in cols) for r in df.collect())
    if name in SQL:
        got = db.execute(SQL[name])
        there = [d[0] for d in got.description]
        assert sorted(there) == cols
        assert rows == Counter(tuple(plain(r[there.index(c)]) for c in cols) for r in got.fetchall())


def test_sql_has_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
