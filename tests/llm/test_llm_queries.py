"""Queries of the subpackage beside their SQL twins on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, column_types, shape
from tessera.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_twin(spark, db, name):
    df = entry.queries()[name](spark, SF)
    cursor = db.execute(entry.oracle_sql()[name])
    types = {c[0]: str(c[1]) for c in cursor.description}
    assert column_types(df) == types
    assert shape(df.columns, df.collect()) == shape(list(types), cursor.fetchall())


def test_all_thirteen_and_the_pipeline_are_registered():
    names = list(entry.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))
    assert "pipeline" in names
