"""Every query with a SQL check gives the same rows as DuckDB; the others give rows."""

import importlib
import sys

import duckdb
import pytest

import __spark_entry__ as contract
from tests.conftest import SMALL
from ticktide.plans.catalogue import QUERIES

TABLES = ("events", "conversations")
DUCK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE",
}
# Several streaming restarts over four slices each; test_streams covers the job in smaller steps.
SLOW = {"stream_prequential", "stream_prequential_sgd"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def ordered_rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    return sorted(tuple(repr(row[at]) for at in order) for row in rows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(spark, duck, sf_dir, name):
    result = contract.queries()[name](spark, sf_dir)
    rows = result.collect()
    assert rows
    check = contract.oracle_sql().get(name)
    if check is None:
        return
    found = duck.execute(check)
    columns, types = [c[0] for c in found.description], {c[0]: str(c[1]) for c in found.description}
    assert sorted(columns) == sorted(result.columns)
    assert {column: DUCK_TYPES[kind] for column, kind in result.dtypes} == types
    assert ordered_rows(rows, result.columns) == ordered_rows(found.fetchall(), columns)


def test_every_check_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 1000


def test_contract_without_the_text_operators(monkeypatch):
    monkeypatch.setitem(sys.modules, "ticktide.llm.queries", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    bare = importlib.reload(contract)
    assert set(bare.queries()) == set(QUERIES) and set(bare.oracle_sql()) <= set(QUERIES)
    monkeypatch.undo()
    importlib.reload(contract)
