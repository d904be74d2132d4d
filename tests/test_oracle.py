"""Every query against its SQL on another engine, and the plans of all queries."""

import re

import pytest

import __spark_entry__ as E
from coursepulse import catalog, oracle
from tests.conftest import SMALL, plan_of

duckdb = pytest.importorskip("duckdb")
TABLES = "customer part events documents".split()


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([r[i] for i in order]) for r in records)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_matches_its_sql(spark, sf, duck, name):
    df = E.queries()[name](spark, sf)
    cursor = duck.execute(E.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, df.collect()) == rows(columns, cursor.fetchall())
    plan = plan_of(df)
    assert not re.search(r"NestedLoop|CartesianProduct|EvalPython|InPandas", plan)


def test_entry(spark, sf):
    assert E.entry(spark).count() == 10
    assert set(oracle.all_sql()) == set(catalog.QUERIES) <= set(E.queries())
