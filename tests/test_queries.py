"""Every registered query next to its SQL twin, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__
from textmine.checks.compare import compare, duckdb_tables
from textmine.checks.oracles import oracles
from textmine.checks.queries import registered

FOLDER = "/root/testdata/sf0.001"
WITHOUT_SQL = {"svc_confusion", "svc_f1"}

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb_tables(FOLDER)
    yield connection
    connection.close()


def test_registry():
    assert set(registered()) - set(oracles()) == WITHOUT_SQL
    assert set(oracles()) <= set(registered())
    assert set(registered()) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(registered()))
def test_query(spark, tables, name):
    assert compare(spark, tables, FOLDER, name) == ""
