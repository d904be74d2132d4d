"""The queries that SQL can express, against that SQL."""

import pytest

from coursepulse.llm import catalog, oracle
from tests.conftest import SMALL
from tests.test_oracle import rows

duckdb = pytest.importorskip("duckdb")


@pytest.mark.parametrize("name", list(oracle.all_sql()))
def test_query_matches_its_sql(spark, sf, name):
    duck = duckdb.connect()
    for table in ("documents", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    df = catalog.QUERIES[name](spark, sf)
    cursor = duck.execute(oracle.all_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, df.collect()) == rows(columns, cursor.fetchall())
