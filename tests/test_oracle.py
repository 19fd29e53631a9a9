from __future__ import annotations

import pytest

import __spark_entry__ as entry
from adapters.queries import CHECKS
from tests.conftest import SF_DIR
from tests.oracle import connect, differences


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_entry(spark):
    assert entry.entry(spark).count() == 6000


def test_every_query_has_sql():
    assert set(CHECKS) <= set(entry.queries()) and set(CHECKS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(CHECKS))
def test_same_as_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) is None
