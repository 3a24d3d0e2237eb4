"""Every registered query against its oracle (or for rows) on the smallest tables."""

import pytest

from minewright.registry import load_all
from tests.oracle import compare, duck

SMALL = "/root/testdata/sf0.001"
PLANS = load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("key", list(PLANS))
def test_query(spark, con, key):
    ok, message = compare(spark, con, PLANS[key], SMALL)
    assert ok, message
