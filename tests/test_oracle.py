"""Every registered query against its DuckDB statement, values and types."""
from collections import Counter

import duckdb
import pytest
from conftest import SMALL

from epidw import oracle, registry

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
QUERIES, STATEMENTS = registry.queries(), oracle.statements()
KINDS = {
    "int": "INTEGER", "bigint": "BIGINT", "smallint": "SMALLINT", "string": "VARCHAR", "date": "DATE",
    "double": "DOUBLE", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    found = QUERIES[name](spark, SMALL)
    cursor = duck.execute(STATEMENTS[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(found.columns) == sorted(columns)
    kinds = {c[0]: str(c[1]) for c in cursor.description}
    assert {f.name: KINDS[f.dataType.simpleString()] for f in found.schema} == kinds
    left = Counter(tuple(row[c] for c in columns) for row in found.collect())
    right = Counter(cursor.fetchall())
    assert left == right
