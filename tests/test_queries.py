"""Every query beside its SQL twin on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.plans import registry
from check import TABLES, column_types, shape

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, db, name):
    df = entry.queries()[name](spark, SF)
    rows = df.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    cursor = db.execute(sql)
    types = {c[0]: str(c[1]) for c in cursor.description}
    assert column_types(df) == types
    assert shape(df.columns, rows) == shape(list(types), cursor.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
