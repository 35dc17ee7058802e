"""Corpus queries that SQL can express, against their DuckDB statements on the whole small tables."""

import pytest

import __spark_entry__ as E
from tests.oracle_compare import compare

from plumeline.llm.oracle import ORACLE


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    assert name in E.oracle_sql()
    res = compare(spark, "/root/testdata/sf0.01", [name], verbose=False)[name]
    assert res.startswith("OK"), res
