"""Every registered query against its SQL counterpart."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from fieldgauge.catalogue import ORACLE, QUERIES
from fieldgauge.schemas import TRANSFORMED_SCHEMA

DATA = Path("/root/testdata/sf0.001")
DUCK_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLE) <= set(entry_module.oracle_sql())


def test_entry_layout(spark):
    df = entry_module.entry(spark)
    assert df.columns == [c for c in TRANSFORMED_SCHEMA.names if c != "processed_at"]
    assert df.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    result = duck.execute(ORACLE[name])
    duck_types = {column[0]: str(column[1]) for column in result.description}
    columns = sorted(df.columns)
    assert columns == sorted(duck_types)
    assert {f.name: DUCK_TYPES[f.dataType.simpleString()] for f in df.schema.fields} == duck_types
    order = [list(duck_types).index(c) for c in columns]
    expected = sorted((tuple(row[i] for i in order) for row in result.fetchall()), key=repr)
    actual = sorted((tuple(row) for row in df.select(*[f"`{c}`" for c in columns]).collect()), key=repr)
    assert actual == expected
