"""Every registered query against its check SQL."""

import pytest

import __spark_entry__ as entry
from tidelog.plans.registry import ORACLES, QUERIES
from tests.compare import connect, spark_side, sql_side
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_check_sql():
    assert set(ORACLES) == set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ours = spark_side(entry.queries()[name](spark, SF_DIR))
    theirs = sql_side(con, entry.oracle_sql()[name])
    assert ours[0] == theirs[0]
    assert ours[1] == theirs[1]
    assert ours[3] == theirs[3]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
