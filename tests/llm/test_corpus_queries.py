"""Corpus queries against their SQL twins on the smallest tables, and how they are listed."""

import pytest

import __spark_entry__ as entry
from check_oracles import compare, connect
from tidemark.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert compare(spark, connect(SF_DIR), name, QUERIES[name], ORACLES[name], SF_DIR) == []


def test_all_are_listed():
    listed = entry.queries()
    assert "pipeline" in listed and set(QUERIES) <= set(listed)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert set(ORACLES) <= set(entry.oracle_sql())
