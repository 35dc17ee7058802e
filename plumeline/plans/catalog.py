"""Named queries: each takes (spark, sf_dir) and returns a DataFrame over the whole fixture tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumeline.functions.names import month_from_name
from plumeline.functions.numeric import lenient_double, lenient_int, round_n
from plumeline.model import CITY_LAT, CITY_LON, CITY_RADIUS_M, PIXEL_SCHEMA
from plumeline.operators import aggregates as A
from plumeline.operators import medallion as M
from plumeline.operators import quality as Q
from plumeline.operators.filters import not_null
from plumeline.operators.sequence import id_block, sequence_ids
from plumeline.operators.spatial import within_radius
from plumeline.plans import fixtures as fx
from plumeline.sources import swath
from plumeline.sources.retention import retained
from plumeline.sources.tables import conform

Query = Callable[[SparkSession, str], DataFrame]


def _pix(spark, d):
    return fx.bronze_pixels(fx.pixels(spark, d))


def _fac(spark, d):
    return fx.bronze_facilities(fx.batteries(spark, d))


def _landing(spark, d):
    return fx.pixels(spark, d)


def _bat(spark, d):
    return fx.batteries(spark, d)


def _geo(spark, d):
    return fx.geocoded_facilities(_bat(spark, d))


def geocode_batteries(spark, d, mode="as_written"):
    g = _geo(spark, d) if mode == "as_written" else fx.geocoded_facilities(_bat(spark, d), mode)
    return not_null(g, "latitude", "longitude").select("row_id", "facility_id", "bty_location_raw",
                                                       "latitude", "longitude")


def geocode_batteries_corrected(spark, d):
    return geocode_batteries(spark, d, "corrected")


def numeric_coercion(spark, d):
    b = _bat(spark, d)
    return b.select("row_id", "gas_prod_text", lenient_double("gas_prod_text").alias("gas_prod_value"),
                    lenient_int("gas_prod_text").alias("gas_prod_int"))


def pixel_filter_bronze(spark, d):
    return _pix(spark, d).select("row_id", "measurement_timestamp", "ch4_column", "qa_value", "latitude",
                                 "longitude", "orbit_number", "scanline", "ground_pixel", "file_path")


def swath_flatten(spark, d):
    return swath.flatten_swath(fx.granules(spark, d))


def rejected_granules(spark, d):
    return swath.granule_load_report(fx.granules(spark, d))


def _batched(spark, d):
    """Fixture pixels as two landing batches: days 1-15, then the rest of the month."""
    pix = _pix(spark, d).select("file_path", "scanline", "ground_pixel", "measurement_timestamp")
    return pix.withColumn("load_batch", F.when(F.dayofmonth("measurement_timestamp") <= 15, 1).otherwise(2))


def append_row_ids(spark, d):
    """Two landing batches appended in order; the second goes on after the rows of the first. The batch is the
    first level of the order, so one numbering gives both."""
    numbered = sequence_ids(_batched(spark, d), ["load_batch", "file_path", "scanline", "ground_pixel"], out="row_id")
    return numbered.select("row_id", "load_batch", "file_path", "scanline", "ground_pixel")


def ids_after_retention(spark, d):
    """W1 + D8: the first batch, retention (30 days before its newest measurement), then the second batch, whose ids go on
    after the highest id ever given out, not after the rows that are left."""
    numbered = sequence_ids(_batched(spark, d), ["load_batch", "file_path", "scanline", "ground_pixel"], out="row_id")
    newest = _batched(spark, d).where("load_batch = 1").agg(F.max("measurement_timestamp")).scalar()
    stays = (F.col("load_batch") == 2) | (F.col("measurement_timestamp") >= newest - F.expr("INTERVAL 30 DAYS"))
    return numbered.where(stays).select("row_id", "load_batch", "file_path", "scanline", "ground_pixel")


def retained_pixels(spark, d):
    """What retention leaves of the bronze pixels."""
    return retained(_pix(spark, d)).select("row_id", "measurement_timestamp", "ch4_column", "file_path", "scanline", "ground_pixel")


def file_row_numbers(spark, d):
    """Numbers restart per file; rows whose file is unknown (NULL) are a file of their own."""
    located = not_null(_geo(spark, d), "latitude", "longitude").select(
        F.when(F.col("row_id") % 97 != 0, F.col("source_file")).alias("source_file"), "row_id")
    return sequence_ids(located, [id_block("row_id"), "row_id"], group_cols=["source_file"], out="file_row")


def month_in_file_name(spark, d):
    """Month of each battery file from its name, in the forms the files use."""
    name = F.when(F.col("row_id") % 3 == 0, F.date_format("reporting_month", "'ST60_'yyyy'_'MM'.csv'")).when(
        F.col("row_id") % 3 == 1, F.date_format("reporting_month", "'st60-'yyyy'-'MM'_v2.csv'")).otherwise(F.lit("no_month_13.csv"))
    named = _bat(spark, d).select("row_id", name.alias("file_name"))
    return named.select("row_id", "file_name", month_from_name("file_name").alias("reporting_month"))


def typed_projection(spark, d):
    """P3 + S8: landing pixels under the bronze schema, by name, as an append writes them."""
    pix = _pix(spark, d).withColumn("measurement_date", F.to_date("measurement_timestamp"))
    return conform(pix, PIXEL_SCHEMA).drop("ingestion_timestamp")


def preferred_season_pixels(spark, d):
    """D7 as a filter: silver pixels of June to August."""
    return M.preferred_season(M.silver_pixels(_pix(spark, d))).select("row_id", "measurement_timestamp", "ch4_column")


def top_operators(spark, d):
    return A.top_operators(_fac(spark, d))


def facility_extent(spark, d):
    return A.facility_extent(_fac(spark, d))


def pixel_extent(spark, d):
    return A.pixel_extent(_pix(spark, d))


def monthly_production(spark, d):
    return A.monthly_production(_fac(spark, d))


def pixel_coverage(spark, d):
    return A.pixel_coverage(_pix(spark, d))


def qa_summary(spark, d):
    return A.qa_summary(_pix(spark, d))


def null_audit(spark, d):
    landing = A.null_audit(_landing(spark, d), "pixels_landing")
    geocoded = A.null_audit(_geo(spark, d), "batteries_geocoded")
    return landing.unionByName(geocoded)


def duplicate_audit(spark, d):
    return A.duplicate_audit(_pix(spark, d))


def facilities_within_radius(spark, d):
    near = within_radius(_fac(spark, d), CITY_LAT, CITY_LON, CITY_RADIUS_M)
    out = near.select("row_id", "facility_id", "operator", round_n("latitude", 4).alias("lat"),
                      round_n("longitude", 4).alias("lon"),
                      round_n(F.col("distance_m") / F.lit(1000.0), 1).alias("distance_km"))
    return out.orderBy("distance_km", "facility_id", "row_id").limit(10).drop("row_id")


def pixels_near_facilities(spark, d):
    return A.pixels_near_facilities(_pix(spark, d), _fac(spark, d))


def overlap_summary(spark, d):
    return A.overlap_summary(_pix(spark, d), _fac(spark, d))


def grid_mean_005(spark, d):
    return A.grid_mean_snap(_pix(spark, d))


def grid_mean_01(spark, d):
    return A.grid_mean_round(_pix(spark, d))


def qa_histogram(spark, d):
    return A.qa_histogram(_pix(spark, d))


def ch4_histogram(spark, d):
    return A.ch4_histogram(_pix(spark, d))


def facility_preview(spark, d):
    return A.facility_preview(_fac(spark, d))


def audit_pixels(spark, d):
    return Q.audit_pixels(_pix(spark, d), _fac(spark, d))


def audit_facilities(spark, d):
    return Q.audit_facilities(_fac(spark, d))


def silver_pixels(spark, d):
    return M.silver_pixels(_pix(spark, d))


def facility_dim(spark, d):
    return M.facility_dim(_fac(spark, d))


def battery_fact(spark, d):
    return M.battery_fact(_fac(spark, d))


def facility_pixel_agg(spark, d):
    return M.facility_pixel_agg(_pix(spark, d), _fac(spark, d))


def ch4_hotspots(spark, d):
    return M.ch4_hotspots(_pix(spark, d))


def hotspots_from_day_states(spark, d):
    """D6 from mergeable states: counts and sums per day and cell, merged and ranked."""
    pix = _pix(spark, d).withColumn("day", F.to_date("measurement_timestamp"))
    return M.hotspots_of(M.cell_states(pix, "day"))


def enhancement_vs_activity(spark, d):
    return M.enhancement_vs_activity(_pix(spark, d), _fac(spark, d))


def activity_correlation(spark, d):
    return M.activity_correlation(M.enhancement_vs_activity(_pix(spark, d), _fac(spark, d)))


QUERIES: dict[str, Query] = {f.__name__: f for f in [
    geocode_batteries, geocode_batteries_corrected, numeric_coercion, pixel_filter_bronze, swath_flatten,
    rejected_granules, append_row_ids, file_row_numbers, top_operators, facility_extent, pixel_extent,
    monthly_production, pixel_coverage, qa_summary, null_audit, duplicate_audit, facilities_within_radius,
    pixels_near_facilities, overlap_summary, grid_mean_005, grid_mean_01, qa_histogram, ch4_histogram,
    facility_preview, audit_pixels, audit_facilities, silver_pixels, facility_dim, battery_fact,
    facility_pixel_agg, ch4_hotspots, enhancement_vs_activity, activity_correlation, month_in_file_name,
    typed_projection, preferred_season_pixels, ids_after_retention, retained_pixels,
    hotspots_from_day_states,
]}
