"""Distance joins against brute force (J1, J2, D5), sequence ids against enumeration."""

import math
import random

import pytest
from pyspark.sql import functions as F

from plumeline.operators.sequence import id_block, sequence_ids
from plumeline.operators.spatial import distance_inner_join, distance_semi_join, within_radius

R = 6371000.0


def hav(a, b, c, d):
    k = 0.017453292519943295
    s1 = math.sin((c - a) * k / 2.0)
    s2 = math.sin((d - b) * k / 2.0)
    x = s1 * s1 + math.cos(a * k) * math.cos(c * k) * s2 * s2
    return 2 * R * math.asin(min(1.0, math.sqrt(x)))


def _points(n, seed, lat=(49.0, 72.0), lon=(-121.0, -109.0)):
    rnd = random.Random(seed)
    return [(i, rnd.uniform(*lat), rnd.uniform(*lon)) for i in range(n)]


@pytest.mark.parametrize("radius", [2500.0, 10000.0, 35000.0])
def test_distance_joins_equal_brute_force(spark, radius):
    left = _points(400, 1)
    right = _points(150, 2) + [(1000, left[0][1], left[0][2])]     # one exact coincidence
    ldf = spark.createDataFrame(left, "id int, latitude double, longitude double")
    rdf = spark.createDataFrame(right, "rid int, latitude double, longitude double")
    pairs = {(a, b) for a, la, lo in left for b, ra, ro in right if hav(la, lo, ra, ro) <= radius}
    near = {a for a, _ in pairs}

    semi = {r.id for r in distance_semi_join(ldf, rdf, radius).collect()}
    inner = distance_inner_join(ldf, rdf, radius).collect()
    assert semi == near
    assert sorted((r.id, r.r_rid) for r in inner) == sorted(pairs)          # each pair exactly once


def test_semi_join_plan_is_hash_join_after_aggregate(spark):
    import __spark_entry__ as E
    plan = E.queries()["pixels_near_facilities"](spark, "/root/testdata/sf0.001")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "LeftSemi" in plan
    # The centre aggregate sits below the semi-join (the join sees centres, not pixel rows).
    semi_at = plan.index("LeftSemi")
    assert "HashAggregate" in plan[semi_at:].split("BroadcastExchange")[0]


def test_within_radius_equals_brute_force(spark):
    pts = _points(500, 3, lat=(50.5, 51.6), lon=(-114.9, -113.2))
    df = spark.createDataFrame(pts, "id int, latitude double, longitude double")
    got = {r.id: r.distance_m for r in within_radius(df, 51.0447, -114.0719, 50000.0).collect()}
    want = {i: hav(a, b, 51.0447, -114.0719) for i, a, b in pts if hav(a, b, 51.0447, -114.0719) <= 50000.0}
    assert set(got) == set(want)
    assert all(got[i] == pytest.approx(want[i], rel=1e-12) for i in got)


def test_sequence_ids_dense_and_ordered(spark):
    rows = [(f"f{i % 3}", (i * 7919) % 1000, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "file string, line int, v int")
    out = sequence_ids(df, ["file", "line"], start=10).collect()
    order = sorted(rows, key=lambda r: (r[0], r[1]))
    assert sorted((r.row_id, r.v) for r in out) == [(10 + k + 1, r[2]) for k, r in enumerate(order)]

    per = sequence_ids(df, ["line"], group_cols=["file"], out="n").collect()
    for f in ("f0", "f1", "f2"):
        got = sorted((r.n, r.line) for r in per if r.file == f)
        lines = sorted(r[1] for r in rows if r[0] == f)
        assert got == list(zip(range(1, len(lines) + 1), lines))


def test_sequence_ids_hot_group_spreads_over_partitions(spark):
    # A third of the rows in one group: the per-(group, partition) offsets keep it exact.
    rows = [("hot" if i % 3 == 0 else f"g{i % 17}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, i int")
    out = sequence_ids(df, [id_block("i", 100), "i"], group_cols=["g"], out="n")
    hot = sorted((r.n, r.i) for r in out.where(F.col("g") == "hot").collect())
    assert hot == list(zip(range(1, 1001), range(0, 3000, 3)))


def test_within_radius_box_reaches_parquet_scan(spark, scratch):
    import os
    pts = _points(300, 5, lat=(50.0, 52.0), lon=(-115.0, -113.0))
    path = os.path.join(scratch, "facilities")
    spark.createDataFrame(pts, "id int, latitude double, longitude double").write.parquet(path)
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")      # do not truncate PushedFilters
    try:
        near = within_radius(spark.read.parquet(path), 51.0447, -114.0719, 50000.0)
        plan = near._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    assert "GreaterThanOrEqual(latitude," in plan and "LessThanOrEqual(longitude," in plan   # PushedFilters
    assert {r.id for r in near.collect()} == {i for i, a, b in pts if hav(a, b, 51.0447, -114.0719) <= 50000.0}
