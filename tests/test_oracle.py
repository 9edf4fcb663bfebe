"""Every registered query agrees with its SQL on the smallest scale."""

import pytest

import __spark_entry__ as entry
from billscope.catalog import ORACLES, QUERIES
from tests.compare import TESTDATA, compare, oracle

SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
