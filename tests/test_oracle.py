"""Every registered query against its SQL on the given tables."""

import os

import pytest
from oracle_check import compare, oracle_connection

import __spark_entry__ as entry
from feedgate.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


def test_every_query_of_the_library_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query(spark, connection, name):
    problem, rows = compare(spark, connection, entry.queries()[name], entry.oracle_sql()[name], SF_DIR)
    assert problem is None
    if name not in ("document_first_errors",):
        assert rows > 0


@pytest.mark.parametrize("name", ["reconcile", "run_summary", "rerun_is_noop", "insert_if_absent", "matched_keys"])
def test_tables_are_read_once(spark, name):
    """The feed is derived and written once; what is returned reads written tables."""
    df = entry.queries()[name](spark, SF_DIR)
    shown = df._jdf.queryExecution().executedPlan().toString()
    assert shown.count("customer.parquet") <= 2


def test_entry(spark):
    assert entry.entry(spark).count() > 0
