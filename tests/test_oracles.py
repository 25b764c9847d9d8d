"""Every query with SQL against DuckDB on the smallest tables: columns, row count and values."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(x):
    return None if x is None or (isinstance(x, float) and math.isnan(x)) else round(x, 6) if isinstance(x, float) else x


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(str(plain(v[i])) for i in order) for v in values)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF)
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [x[0] for x in cursor.description]
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(names, cursor.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
