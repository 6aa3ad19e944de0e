"""Every registered query against its SQL counterpart on the smallest tables."""

import os

import pytest

import __spark_entry__ as registry

duckdb = pytest.importorskip("duckdb")
TABLES = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="tables not present")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in ("documents", "pages", "labels", "embeddings", "nation", "benchmark", "conversations"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TABLES}/{name}.parquet'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, database, name):
    frame = registry.queries()[name](spark, TABLES)
    rows = canonical(frame.columns, frame.collect())
    statement = registry.oracle_sql().get(name)
    if statement is None:
        assert rows[1]
        return
    result = database.execute(statement)
    assert rows == canonical([d[0] for d in result.description], result.fetchall())


def test_every_statement_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())
