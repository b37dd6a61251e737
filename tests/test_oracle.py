"""Every catalog query against its DuckDB twin on whole tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from perron.plans.catalog import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "decimal(10,7)": "DECIMAL(10,7)",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, sf_dir, name):
    df = contract.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = [tuple(row[c] for c in columns) for row in df.collect()]
    result = duck.execute(contract.oracle_sql()[name])
    place = {d[0]: i for i, d in enumerate(result.description)}
    types = {d[0]: str(d[1]) for d in result.description}
    assert columns == sorted(place)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == types
    expected = [tuple(row[place[c]] for c in columns) for row in result.fetchall()]
    assert ordered(got) == ordered(expected)
    assert got


def test_entry(spark):
    assert contract.entry(spark).columns == ["date", "avg_delay"]


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(contract.queries()) & set(contract.oracle_sql())
