"""Registered queries next to their SQL at the smallest scale."""

import pytest
from check_oracles import compare, connect

from tallyloom.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, con, key):
    ok, note, _ = compare(spark, con, key, QUERIES[key], ORACLES.get(key), FOLDER)
    assert ok, note
