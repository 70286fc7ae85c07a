"""Every registered query against its SQL, as sets of rows with equal types."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from opsledger.plans import oracle, queries
from tests.conftest import SF

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}
QUERIES = {name: query for name, query in contract.queries().items() if name in queries.registry()}
ORACLES = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, sf, duck, capsys):
    found = QUERIES[name](spark, sf)
    found.explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    columns = sorted(found.columns)
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    expected = Counter(
        tuple(row[names.index(c)] for c in columns) for row in cursor.fetchall()
    )
    assert sorted(names) == columns
    assert Counter(tuple(row[c] for c in columns) for row in found.collect()) == expected
    types = {row[0]: row[1] for row in duck.execute(f"DESCRIBE {ORACLES[name]}").fetchall()}
    assert {c: TYPES[t] for c, t in found.dtypes} == types


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_has_one_row(spark):
    assert contract.entry(spark).count() == 1
