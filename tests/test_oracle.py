"""Every registered query against its SQL twin on the driver's smallest tables."""

import pytest

import __spark_entry__ as entry
from workload.check import compare, database
from workload.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return database(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, connection, name):
    assert name in entry.oracle_sql()
    assert compare(spark, connection, SF_DIR, name).startswith("ok")


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
