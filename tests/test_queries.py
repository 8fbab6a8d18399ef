import os

import duckdb
import pytest

import __spark_entry__

DIR = "/root/testdata/sf0.001"
QUERIES, SQL = __spark_entry__.queries(), __spark_entry__.oracle_sql()
CORE = [q for q in SQL if not q.startswith("op") and q != "pipeline"]


def plain(v):
    if v is None or v != v:
        return None
    return round(float(v), 6) + 0.0 if isinstance(v, (int, float)) and not isinstance(v, bool) else v


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for f in os.listdir(DIR):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{DIR}/{f}')")
    return con


@pytest.mark.parametrize("name", CORE)
def test_same_rows_as_sql(spark, sql, name):
    got = QUERIES[name](spark, DIR)
    want = sql.execute(SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    rows = lambda all_: sorted((tuple(plain(v) for v in r) for r in all_), key=str)
    assert rows(want.fetchall()) == rows(tuple(r[c] for c in columns) for r in got.collect())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
