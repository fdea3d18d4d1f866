"""Every registered query against its check SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_module
from check_queries import compare, duck

SMALL = "/root/testdata/sf0.001"
CHECKS = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", list(entry_module.queries()))
def test_query(spark, con, name):
    status, n, _, note = compare(spark, con, SMALL, name, entry_module.queries()[name], CHECKS.get(name))
    assert status in ("OK", "ROWS"), note


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(entry_module.queries())
