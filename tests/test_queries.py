"""Every query with an SQL twin against DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

from framewright.plans.queries import ORACLE_SQL, QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(DIR):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{DIR}/{name}'")
    return con


def plain(value):
    if isinstance(value, float):
        return repr(round(value, 6) + 0.0)
    return tuple(map(plain, value)) if isinstance(value, (list, tuple)) else str(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, duck, name):
    df = QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cursor = duck.execute(ORACLE_SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in order) for r in cursor.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
