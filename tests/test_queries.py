"""Every registered query against DuckDB on the smallest given tables."""

import os

import pytest

from compare import connect, differences
from evenkeel.plans.oracles import ORACLES
from evenkeel.plans.suites import QUERIES

FOLDER = os.environ.get("EVENKEEL_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_an_expected_result():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert differences(QUERIES[name](spark, FOLDER), duck, ORACLES[name]) is None
