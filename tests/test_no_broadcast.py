"""With automatic broadcasting off (a side too large to broadcast), the distance joins and the
geocode join fall back to shuffled joins and give the same results."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_ORACLE
from tests.oracle_compare import compare

NAMES = ["pixels_near_facilities", "overlap_summary", "facility_pixel_agg", "enhancement_vs_activity",
         "monthly_production"]


@pytest.fixture()
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_shuffled_joins_match_oracle(no_broadcast):
    res = compare(no_broadcast, SF_ORACLE, NAMES, verbose=False)
    assert all(v.startswith("OK") for v in res.values()), res


def test_shuffled_semi_join_plan(no_broadcast):
    df = E.queries()["pixels_near_facilities"](no_broadcast, "/root/testdata/sf0.001")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "NestedLoopJoin" not in plan
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan


def test_hot_location_and_hot_duplicate_key(no_broadcast):
    """A third of the rows share one location / one natural key: results stay exact."""
    import datetime as dt

    from pyspark.sql import functions as F

    from plumeline.functions.location import with_location
    from plumeline.operators.medallion import silver_pixels

    spark = no_broadcast
    n = 6000
    locs = spark.range(n).select(
        F.col("id").alias("i"),
        F.when(F.col("id") % 3 == 0, F.lit("02-21-065-04W4"))
         .otherwise(F.concat(F.lpad(((F.col("id") % 16) + 1).cast("string"), 2, "0"), F.lit("-01-0"),
                             F.lpad(((F.col("id") % 90) + 10).cast("string"), 2, "0"), F.lit("-01W5"))).alias("loc"))
    out = with_location(locs, "loc", located_only=True)
    assert out.count() == n
    assert out.where(F.col("loc") == "02-21-065-04W4").select("latitude").distinct().count() == 1

    ts = dt.datetime(2024, 1, 10)
    pix = spark.range(n).select(
        F.col("id").alias("row_id"), F.lit(ts).cast("timestamp_ntz").alias("measurement_timestamp"),
        F.lit(1800.0).alias("ch4_column"), F.lit(0.9).alias("qa_value"), F.lit(51.0).alias("latitude"),
        F.lit(-114.0).alias("longitude"), F.lit(36000).alias("orbit_number"), F.lit("f.nc").alias("file_path"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("scanline"),
        F.lit(0).alias("ground_pixel"))
    silver = silver_pixels(pix)
    assert silver.count() == n - (n // 3) + 1
    assert silver.where(F.col("scanline") == 0).select("row_id").collect()[0].row_id == 0
