"""Plan properties of every registered query: no pairwise joins, no Python execution, and scans
that read only the columns the query needs."""

import re

import pytest

from plumeline.plans.catalog import QUERIES

FORBIDDEN = ["NestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
             "MapInPandas", "PythonUDF"]
UNUSED = {"events": {"user_id", "event_type", "value", "props"},
          "orders": {"o_orderstatus", "o_totalprice", "o_orderpriority"}}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_properties(spark, name):
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        df = QUERIES[name](spark, "/root/testdata/sf0.001")
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    for op in FORBIDDEN:
        assert op not in plan, (name, op)
    scans = 0
    for table, unused in UNUSED.items():
        for schema in re.findall(rf"{table}\.parquet\].*?ReadSchema: struct<([^>]*)>", plan):
            scans += 1
            read = {c.split(":")[0] for c in schema.split(",")}
            assert not (read & unused), (name, table, read & unused)
    assert scans >= 1 and "ExistingRDD" not in plan, name          # every query reads the events or orders table


def test_shape_of_costly_plans(spark):
    """Few references to the histogram's bounds, no expanded rows in coverage counts, numbering scans its source twice at most."""
    def final(name):
        df = QUERIES[name](spark, "/root/testdata/sf0.001")
        df.collect()
        return df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().executedPlan().toString()

    assert final("ch4_histogram")[0].count("scalar-subquery#") <= 6
    assert "Expand" not in final("pixel_coverage")[1]
    assert "Expand" not in final("duplicate_audit")[1]
    for name in ("append_row_ids", "file_row_numbers"):
        plan = final(name)[1]
        assert plan[plan.find("Final Plan"):plan.find("Initial Plan")].count("FileScan parquet") <= 2, name
    for name in ("facility_pixel_agg", "enhancement_vs_activity", "activity_correlation"):
        plan = final(name)[1]
        plan = plan[plan.find("Final Plan"):plan.find("Initial Plan")]
        assert len(re.findall(r"FileScan parquet[^\n]*events\.parquet", plan)) == 1, name
