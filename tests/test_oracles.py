"""Every registered query with SQL gives DuckDB's rows on the driver's smallest tables; the others run."""

import os

import duckdb
import pytest

from tessera.queries import QUERIES, SQL

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return f"{v:.6g}"
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF)
    rows = got.collect()
    if name not in SQL:
        assert rows
        return
    want = duck.execute(SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert rows_of(got.columns, rows) == rows_of(names, want.fetchall())
