"""Every registered query with SQL gives the same rows as DuckDB over the smallest tables."""

import glob
import os

import duckdb
import pytest

from docloom.plans import catalogue

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    return round(float(value), 6) if isinstance(value, float) else value


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, tables, name):
    df = catalogue.QUERIES[name](spark, FOLDER)
    found = df.collect()
    if name in catalogue.ORACLES:
        wanted = tables.sql(catalogue.ORACLES[name])
        assert sorted(df.columns) == sorted(wanted.columns)
        assert rows(df.columns, found) == rows(wanted.columns, wanted.fetchall())
    else:
        assert found


def test_entry_points_work_without_the_subpackage():
    import __spark_entry__ as entry

    assert set(catalogue.QUERIES) <= set(entry.queries()) and set(catalogue.ORACLES) <= set(entry.oracle_sql())
