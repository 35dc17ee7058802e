"""Every catalogue query against its DuckDB statement (row count, columns, exact values)."""

import pytest

import __spark_entry__ as E
from plumeline.plans.catalog import QUERIES
from plumeline.plans.oracle import oracle_sql
from tests.conftest import SF_ORACLE
from tests.oracle_compare import compare

NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(oracle_sql()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_ORACLE, [name], verbose=False)[name]
    assert res.startswith("OK"), res


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].pixels_near_facilities > 0


def test_hotspots_at_larger_scale(spark):
    # Empty at sf0.01 (too few gold pixels per cell); sf0.1 has qualifying cells.
    res = compare(spark, "/root/testdata/sf0.1", ["ch4_hotspots"], verbose=False)["ch4_hotspots"]
    assert res.startswith("OK") and not res.startswith("OK (0 rows"), res


def test_column_types_match_oracle(spark):
    from tests.oracle_compare import duck
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
             "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    con = duck(SF_ORACLE)
    sql = oracle_sql()
    for name, q in QUERIES.items():
        got = {f.name: names.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in q(spark, SF_ORACLE).schema.fields}
        rel = con.sql(sql[name])
        assert got == {c: str(t) for c, t in zip(rel.columns, rel.types)}, name
