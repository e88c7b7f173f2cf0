"""Every registered query against its SQL check, whole results, values equal."""

import pytest

import __spark_entry__ as entry
from oracle import sql as checks
from stratalake import catalog
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES = catalog.queries()
CHECKS = checks.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    message, _ = compare(spark, con, QUERIES[name], CHECKS[name], SF)
    assert message is None, message


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries())
    assert set(CHECKS) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 20
