"""Every registered query against its check SQL on the smallest tables."""

import pytest
from oracle import compare, duck

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
QUERIES, CHECKS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_check(spark, con, name):
    ok, _, message = compare(name, QUERIES[name](spark, SF_DIR), con, CHECKS[name])
    assert ok, message


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS)))
def test_query_without_check_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_checks_belong_to_queries():
    assert set(CHECKS) <= set(QUERIES)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
