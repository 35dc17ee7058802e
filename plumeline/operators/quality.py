"""Data-quality gates (G1-G9): metrics -> rows of (check, value, status).

Every metric of a table comes from one aggregate pass; the overlap check (G7) and the city
check (G9) are scalar subqueries. The metric row is turned into check rows with ``stack``.
Status is PASSED / WARNING / FAILED (INFO for informational checks).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumeline.functions.numeric import round_n
from plumeline.model import (AUDIT_AVG_CH4_MAX, AUDIT_AVG_CH4_MIN, AUDIT_AVG_QA_MIN, AUDIT_MIN_ORBITS,
                             AUDIT_MIN_ROWS, BBOX, CITY_LAT, CITY_LON, CITY_RADIUS_M, FACILITY_BUFFER_M)
from plumeline.operators.aggregates import duplicate_ids, duplicate_keys, pixels_near_facilities
from plumeline.operators.spatial import within_radius


def _n():
    return F.count(F.lit(1))


def _stack(metrics: DataFrame, checks: list[tuple[str, Column, Column]]) -> DataFrame:
    """``checks`` = (name, value, status) evaluated on the one-row ``metrics`` frame."""
    rows = metrics.select(*[F.struct(F.lit(name).alias("check"), value.cast("double").alias("value"),
                                     status.alias("status")).alias(f"_c{i}")
                            for i, (name, value, status) in enumerate(checks)])
    return rows.select(F.inline(F.array(*[F.col(f"_c{i}") for i in range(len(checks))])))


def _inside(lo: Column, hi: Column, bound_lo: float, bound_hi: float) -> Column:
    return (F.lit(bound_lo) <= lo) & (lo <= hi) & (hi <= F.lit(bound_hi))


def audit_pixels(pix: DataFrame, fac: DataFrame, radius_m: float = FACILITY_BUFFER_M) -> DataFrame:
    """G1-G8 on the bronze pixel table."""
    m = pix.agg(
        _n().alias("n"),
        F.count_distinct("orbit_number").alias("orbits"),
        round_n(F.min("latitude"), 2).alias("min_lat"), round_n(F.max("latitude"), 2).alias("max_lat"),
        round_n(F.min("longitude"), 2).alias("min_lon"), round_n(F.max("longitude"), 2).alias("max_lon"),
        round_n(F.avg("qa_value"), 3).alias("avg_qa"),
        F.avg("ch4_column").alias("avg_ch4"),
        F.count_if(F.col("latitude").isNull() | F.col("longitude").isNull()).alias("null_loc"))
    m = m.withColumn("dups", duplicate_ids(pix).select("dups").scalar())
    near = pixels_near_facilities(pix, fac, radius_m).agg(_n().alias("near")).scalar()
    m = m.withColumn("near", near)
    n = F.col("n")
    bbox_ok = (_inside(F.col("min_lat"), F.col("max_lat"), BBOX["min_lat"], BBOX["max_lat"])
               & _inside(F.col("min_lon"), F.col("max_lon"), BBOX["min_lon"], BBOX["max_lon"]))

    def ok_or(cond, otherwise="WARNING"):
        return F.when(cond, F.lit("PASSED")).otherwise(F.lit(otherwise))

    return _stack(m, [
        ("row_count", n, F.when(n == 0, F.lit("FAILED")).when(n < AUDIT_MIN_ROWS, F.lit("WARNING"))
         .otherwise(F.lit("PASSED"))),
        ("orbit_coverage", F.col("orbits"), ok_or(F.col("orbits") >= AUDIT_MIN_ORBITS)),
        ("extent_in_bbox", bbox_ok.cast("int"), ok_or(F.coalesce(bbox_ok, F.lit(False)))),
        ("mean_qa", F.col("avg_qa"), ok_or(F.col("avg_qa") >= AUDIT_AVG_QA_MIN)),
        ("mean_ch4", round_n("avg_ch4", 2),
         ok_or(F.col("avg_ch4").between(AUDIT_AVG_CH4_MIN, AUDIT_AVG_CH4_MAX))),
        ("missing_location", F.col("null_loc"), ok_or(F.col("null_loc") == 0, "FAILED")),
        ("facility_overlap", F.col("near"), ok_or(F.col("near") >= 1)),
        ("duplicate_row_ids", F.col("dups"), ok_or(F.col("dups") == 0)),
    ])


def audit_facilities(fac: DataFrame) -> DataFrame:
    """G1, G3 (latitude only), G6 and G9 on the bronze facility table."""
    m = fac.agg(
        _n().alias("n"),
        round_n(F.min("latitude"), 2).alias("min_lat"), round_n(F.max("latitude"), 2).alias("max_lat"),
        F.count_if(F.col("latitude").isNull() | F.col("longitude").isNull()).alias("null_loc"))
    city = within_radius(fac, CITY_LAT, CITY_LON, CITY_RADIUS_M).agg(_n().alias("c")).scalar()
    m = m.withColumn("near_city", city)
    lat_ok = (F.col("min_lat") >= F.lit(BBOX["min_lat"])) & (F.col("max_lat") <= F.lit(BBOX["max_lat"]))
    return _stack(m, [
        ("row_count", F.col("n"), F.when(F.col("n") == 0, F.lit("WARNING")).otherwise(F.lit("PASSED"))),
        ("latitude_in_bbox", lat_ok.cast("int"),
         F.when(F.coalesce(lat_ok, F.lit(False)), F.lit("PASSED")).otherwise(F.lit("WARNING"))),
        ("missing_location", F.col("null_loc"),
         F.when(F.col("null_loc") == 0, F.lit("PASSED")).otherwise(F.lit("WARNING"))),
        ("facilities_near_city", F.col("near_city"), F.lit("INFO")),
    ])


def pixel_gates(rows: DataFrame) -> DataFrame:
    """G1-G8 on a staged batch of pixels, before it is published: what makes a batch unfit FAILED, the rest WARNING.

    One pass over the batch; the natural key takes the place of the row id, which a staged row does not have yet.
    """
    m = rows.agg(
        _n().alias("n"), F.avg("qa_value").alias("avg_qa"), F.avg("ch4_column").alias("avg_ch4"),
        F.count_if(F.col("latitude").isNull() | F.col("longitude").isNull()).alias("null_loc"),
        F.count_if(~(F.col("latitude").between(BBOX["min_lat"], BBOX["max_lat"])
                     & F.col("longitude").between(BBOX["min_lon"], BBOX["max_lon"]))).alias("outside"),
        F.count_if(~F.col("qa_value").between(0, 1)).alias("bad_qa"))
    m = m.withColumn("dups", duplicate_keys(rows, ["file_path", "scanline", "ground_pixel"]).scalar())
    n = F.col("n")

    def gate(cond, otherwise="FAILED"):
        return F.when(F.coalesce(cond, F.lit(False)), F.lit("PASSED")).otherwise(F.lit(otherwise))

    return _stack(m, [
        ("row_count", n, F.when(n == 0, F.lit("FAILED")).when(n < AUDIT_MIN_ROWS, F.lit("WARNING")).otherwise(F.lit("PASSED"))),
        ("extent_in_bbox", F.col("outside"), gate(F.col("outside") == 0)),
        ("missing_location", F.col("null_loc"), gate(F.col("null_loc") == 0)),
        ("qa_in_range", F.col("bad_qa"), gate(F.col("bad_qa") == 0)),
        ("mean_qa", round_n("avg_qa", 3), gate(F.col("avg_qa") >= AUDIT_AVG_QA_MIN, "WARNING")),
        ("mean_ch4", round_n("avg_ch4", 2), gate(F.col("avg_ch4").between(AUDIT_AVG_CH4_MIN, AUDIT_AVG_CH4_MAX), "WARNING")),
        ("duplicate_natural_keys", F.col("dups"), gate(F.col("dups") == 0)),
    ])


def facility_gates(rows: DataFrame) -> DataFrame:
    """G1, G3 and G6 on a staged batch of facility rows: no row, or a row without coordinates, FAILED."""
    m = rows.agg(
        _n().alias("n"), F.count_if(F.col("latitude").isNull() | F.col("longitude").isNull()).alias("null_loc"),
        F.count_if(~F.col("latitude").between(BBOX["min_lat"], BBOX["max_lat"])).alias("outside"),
        F.count_if(F.col("reporting_month").isNull()).alias("no_month"))

    def gate(name, otherwise="FAILED"):
        return F.when(F.col(name) == 0, F.lit("PASSED")).otherwise(F.lit(otherwise))

    return _stack(m, [
        ("row_count", F.col("n"), F.when(F.col("n") == 0, F.lit("FAILED")).otherwise(F.lit("PASSED"))),
        ("missing_location", F.col("null_loc"), gate("null_loc")),
        ("missing_month", F.col("no_month"), gate("no_month")),
        ("latitude_in_bbox", F.col("outside"), gate("outside", "WARNING")),
    ])
