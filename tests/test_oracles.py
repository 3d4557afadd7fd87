"""Every query equals its checking SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from compare import connect, spark_rows, sql_rows
from spendlake.catalog.oracles import ORACLES
from spendlake.catalog.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    columns, found = spark_rows(entry_module.queries()[name](spark, FOLDER))
    wanted_columns, wanted = sql_rows(connection, entry_module.oracle_sql()[name])
    assert columns == wanted_columns
    assert found == wanted
