"""Registered corpus queries next to their SQL at the smallest scale, and the driver entry that lists them."""

import __spark_entry__
import pytest
from check_oracles import compare, connect

from tallyloom.llm.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query(spark, key):
    ok, note, _ = compare(spark, connect(FOLDER), key, QUERIES[key], ORACLES[key], FOLDER)
    assert ok, note


def test_entry_lists_all():
    names = __spark_entry__.queries()
    assert "pipeline" in names and [n for n in range(1, 14) if not any(k.startswith(f"op{n}_") for k in names)] == []
    assert set(__spark_entry__.oracle_sql()) <= set(names)
