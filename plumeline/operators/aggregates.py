"""Aggregations, histograms, grids and top-k reports.

All of them aggregate partially on the map side, so a hot key is collapsed before the shuffle.
Data-dependent bounds (histogram range, totals) are scalar subqueries, never driver round trips.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumeline.functions.numeric import grid_snap, round_n
from plumeline.model import (CH4_MAX_VALID, CH4_MIN_VALID, FACILITY_BUFFER_M, HEATMAP_GRID_DEG, HIST_BINS,
                             QA_SILVER)
from plumeline.operators.filters import ch4_in_range, not_null, positive_production, qa_at_least
from plumeline.operators.spatial import distance_semi_join


def _n():
    return F.count(F.lit(1))


def row_count(df: DataFrame) -> DataFrame:
    """A1."""
    return df.agg(_n().alias("total_rows"))


def top_operators(fac: DataFrame, k: int = 10) -> DataFrame:
    """A2 + T1: rows per operator, top k; ties broken by operator name."""
    return (not_null(fac, "operator").groupBy("operator").agg(_n().alias("facility_count"))
            .orderBy(F.col("facility_count").desc(), F.col("operator").asc()).limit(k))


def facility_extent(fac: DataFrame) -> DataFrame:
    """A3 on facilities: rounded bounds; ranges are rounded after subtracting."""
    return fac.agg(
        round_n(F.min("latitude"), 2).alias("min_lat"), round_n(F.max("latitude"), 2).alias("max_lat"),
        round_n(F.min("longitude"), 2).alias("min_lon"), round_n(F.max("longitude"), 2).alias("max_lon"),
        round_n(F.max("latitude") - F.min("latitude"), 2).alias("lat_range"),
        round_n(F.max("longitude") - F.min("longitude"), 2).alias("lon_range"))


def pixel_extent(pix: DataFrame) -> DataFrame:
    """A3 on pixels."""
    return pix.agg(
        round_n(F.min("latitude"), 2).alias("min_lat"), round_n(F.max("latitude"), 2).alias("max_lat"),
        round_n(F.min("longitude"), 2).alias("min_lon"), round_n(F.max("longitude"), 2).alias("max_lon"))


def monthly_production(fac: DataFrame) -> DataFrame:
    """A4 + F6 + T3. ``sum(flared + vented)`` skips a row where either is NULL; the ratio is
    NULL when production sums to 0."""
    g = positive_production(fac).groupBy("reporting_month").agg(
        _n().alias("num_facilities"),
        F.sum("gas_prod_1000m3").alias("_prod"),
        F.sum("gas_flared_1000m3").alias("_flared"),
        F.sum("gas_vented_1000m3").alias("_vented"),
        F.sum(F.col("gas_flared_1000m3") + F.col("gas_vented_1000m3")).alias("_emitted"))
    return g.select(
        "reporting_month", "num_facilities",
        round_n("_prod", 1).alias("total_gas_prod_1000m3"),
        round_n("_flared", 1).alias("total_gas_flared_1000m3"),
        round_n("_vented", 1).alias("total_gas_vented_1000m3"),
        round_n(F.col("_emitted") / F.nullif(F.col("_prod"), F.lit(0.0)) * F.lit(100.0), 2).alias("pct_emissions"),
    ).orderBy("reporting_month")


def bitmap_state(pix: DataFrame) -> DataFrame:
    """Mergeable state of the coverage counts: rows, first and last time, and bitmaps of the days and orbits, one row per
    pair of bitmap blocks (32,768 days or orbits each). States of parts of a table merge by ``bitmap_or_agg``."""
    day, orbit = F.unix_date(F.to_date("measurement_timestamp")).cast("long"), F.col("orbit_number").cast("long")
    return pix.groupBy(F.bitmap_bucket_number(day).alias("day_block"), F.bitmap_bucket_number(orbit).alias("orbit_block")).agg(
        _n().alias("n"), F.min("measurement_timestamp").alias("first_date"), F.max("measurement_timestamp").alias("last_date"),
        F.bitmap_construct_agg(F.bitmap_bit_position(day)).alias("days"), F.bitmap_construct_agg(F.bitmap_bit_position(orbit)).alias("orbits"))


def distinct_in(state: DataFrame, block: str, bitmap: str):
    """Distinct values of one bitmap column of a state, as a scalar subquery."""
    merged = state.groupBy(block).agg(F.bitmap_or_agg(bitmap).alias("m"))
    return merged.agg(F.coalesce(F.sum(F.bitmap_count("m")), F.lit(0)).cast("long")).scalar()


def pixel_coverage(pix: DataFrame) -> DataFrame:
    """A1 + A5 + X9. Distinct days and orbits come from bitmaps: the rows are not expanded per distinct count, and the
    one aggregate over them is shared by the three results."""
    state = bitmap_state(pix)
    return state.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.min("first_date").alias("first_date"),
                     F.max("last_date").alias("last_date")).select(
        "total_rows", "first_date", "last_date", distinct_in(state, "day_block", "days").alias("unique_dates"),
        distinct_in(state, "orbit_block", "orbits").alias("unique_orbits"))


def qa_summary(pix: DataFrame, high_qa: float = 0.3) -> DataFrame:
    """A6 + A7."""
    g = pix.agg(F.avg("qa_value").alias("_qa"),
                F.count_if(F.col("qa_value") >= F.lit(high_qa)).alias("high_quality"),
                _n().alias("total"),
                F.avg("ch4_column").alias("_ch4"))
    return g.select(round_n("_qa", 3).alias("avg_qa"), "high_quality", "total",
                    round_n(F.col("high_quality") / F.nullif(F.col("total"), F.lit(0)) * F.lit(100.0), 2)
                    .alias("high_quality_pct"),
                    round_n("_ch4", 2).alias("avg_ch4"))


def null_audit(df: DataFrame, table: str, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """A point is missing when either coordinate is."""
    has = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    return df.agg(_n().alias("total_rows"), F.count_if(has).alias("rows_with_location"),
                  F.count_if(~has).alias("rows_without_location")).select(
        F.lit(table).alias("table_name"), "*")


def duplicate_ids(df: DataFrame, col: str = "row_id") -> DataFrame:
    """One row (n, dups): rows, and rows beyond the first of each id (NULL ids all count as duplicates)."""
    extra = F.when(F.col(col).isNull(), F.col("n")).otherwise(F.col("n") - 1)
    per_id = df.groupBy(col).agg(_n().alias("n"))
    return per_id.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(extra), F.lit(0)).alias("dups"))


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """One row (dups): rows beyond the first of each key.

    Rows are counted by a 64-bit hash of the key first; only rows of hashes that occur more than once are
    grouped by the key itself, so a hash collision is not taken for a duplicate.
    """
    hashed = df.select(*keys).withColumn("_h", F.xxhash64(*keys))
    several = hashed.groupBy("_h").agg(_n().alias("_n")).where("_n > 1").select("_h")
    exact = hashed.join(several, "_h", "left_semi").groupBy(*keys).agg(_n().alias("n"))
    return exact.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("dups"))


def duplicate_audit(pix: DataFrame, key_cols=("file_path", "scanline", "ground_pixel")) -> DataFrame:
    """``count(*) - count(distinct row_id)`` (NULL ids count as duplicates), plus the same on
    the natural key, which catches a reloaded file that got fresh ids. One plain aggregate per key,
    no expansion of the rows."""
    natural = duplicate_keys(pix, list(key_cols)).scalar()
    return duplicate_ids(pix).select(F.col("n").alias("total_rows"), F.col("dups").alias("duplicate_row_ids"),
                                     natural.alias("duplicate_natural_keys"))


def pixel_centres(pix: DataFrame, step_digits: int = 1) -> DataFrame:
    """A10: distinct pixel centres at 10^-digits degrees (rounded half away from zero), with the
    number of pixels each one stands for.

    Rows without coordinates are dropped first, so the centre keys are declared non-null: a later
    join then infers no extra null filters beneath this aggregate, and two uses of it stay
    identical plans that share one shuffle. The ``n_pixels > 0`` condition is always true; it
    keeps the aggregate below a following semi-join (Catalyst would otherwise push a broadcastable
    semi-join beneath it, and every pixel row, not every centre, would probe the facility cells).
    """
    located = pix.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    lat_c = F.coalesce(round_n("latitude", step_digits), F.lit(0.0)).alias("lat_center")
    lon_c = F.coalesce(round_n("longitude", step_digits), F.lit(0.0)).alias("lon_center")
    return located.groupBy(lat_c, lon_c).agg(_n().alias("n_pixels")).where(F.col("n_pixels") > 0)


def pixels_near_facilities(pix: DataFrame, fac: DataFrame, radius_m: float = FACILITY_BUFFER_M) -> DataFrame:
    """J1 + A10: distinct centres with a facility within ``radius_m``."""
    return distance_semi_join(pixel_centres(pix), fac, radius_m, "lat_center", "lon_center",
                              "latitude", "longitude")


def overlap_summary(pix: DataFrame, fac: DataFrame, radius_m: float = FACILITY_BUFFER_M) -> DataFrame:
    """Centres in total (before the semi-join), facility rows, centres near one, percent.

    Both centre counts come from one aggregate: every centre is left-joined to the (small) set
    of near centres, and the two identical centre aggregates share one shuffle (exchange reuse),
    so the pixel table is read once.
    """
    centres = pixel_centres(pix)
    near = distance_semi_join(centres, fac, radius_m, "lat_center", "lon_center", "latitude", "longitude")
    flagged = centres.join(near.select("lat_center", "lon_center", F.lit(1).alias("_near")),
                           ["lat_center", "lon_center"], "left")
    n_fac = fac.agg(_n().alias("total_facilities"))
    return flagged.agg(_n().alias("total_pixels"), F.count("_near").alias("pixels_near_facilities")).select(
        "total_pixels", n_fac.scalar().alias("total_facilities"), "pixels_near_facilities",
        round_n(F.col("pixels_near_facilities") / F.nullif(F.col("total_pixels"), F.lit(0)) * F.lit(100.0), 2)
        .alias("overlap_pct"))


def grid_mean_snap(pix: DataFrame, step: float = HEATMAP_GRID_DEG, qa_min: float = QA_SILVER) -> DataFrame:
    """A11 + X7: half-to-even grid snap, mean CH4 per cell."""
    return (qa_at_least(pix, qa_min)
            .groupBy(grid_snap("latitude", step).alias("lat_grid"), grid_snap("longitude", step).alias("lon_grid"))
            .agg(F.avg("ch4_column").alias("avg_ch4"), _n().alias("n_pixels")))


def grid_mean_round(pix: DataFrame, digits: int = 1, qa_min: float = QA_SILVER) -> DataFrame:
    """Rounded coordinates (half away from zero), mean CH4 per cell."""
    return (qa_at_least(pix, qa_min)
            .groupBy(round_n("latitude", digits).alias("lat_grid"), round_n("longitude", digits).alias("lon_grid"))
            .agg(F.avg("ch4_column").alias("avg_ch4"), _n().alias("n_pixels")))


def qa_histogram(pix: DataFrame) -> DataFrame:
    """A13 + T3: pixel count per 0.1 QA bin, ordered."""
    return (pix.groupBy(round_n("qa_value", 1).alias("qa_bin")).agg(_n().alias("count"))
            .orderBy("qa_bin"))


def ch4_histogram(pix: DataFrame, bins: int = HIST_BINS, lo: float = CH4_MIN_VALID,
                  hi: float = CH4_MAX_VALID) -> DataFrame:
    """A14 + A15 + F4: equal-width bins over the data's own min..max inside [lo, hi]; the last
    bin is closed; equal bounds widen to +-0.5. Every bin is reported, empty ones with 0. The
    range mean is carried on each row."""
    vals = ch4_in_range(pix, "ch4_column", lo, hi).select("ch4_column")
    stats = vals.agg(F.struct(F.min("ch4_column").alias("mn"), F.max("ch4_column").alias("mx"),
                              F.avg("ch4_column").alias("mean")).alias("s")).scalar()

    def with_bounds(df: DataFrame) -> DataFrame:
        """``df`` with the bounds and the mean as columns; one reference to the subquery, read once per row."""
        mn, mx = F.col("_s.mn"), F.col("_s.mx")
        low = F.when(mn == mx, mn - F.lit(0.5)).otherwise(mn)
        high = F.when(mn == mx, mx + F.lit(0.5)).otherwise(mx)
        return df.withColumn("_s", stats).withColumns({"_lo": low, "_hi": high}).withColumn("_width", F.col("_hi") - F.col("_lo"))

    place = F.floor((F.col("ch4_column") - F.col("_lo")) / F.col("_width") * F.lit(float(bins))) + F.lit(1)
    counts = with_bounds(vals).groupBy(F.least(place, F.lit(bins)).cast("int").alias("bin")).agg(_n().alias("pixel_count"))
    edge = lambda k: F.col("_lo") + F.col("_width") * k.cast("double") / F.lit(float(bins))
    edges = with_bounds(pix.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))).where("_lo is not null").select(
        "bin", edge(F.col("bin") - F.lit(1)).alias("bin_lo"), edge(F.col("bin")).alias("bin_hi"), F.col("_s.mean").alias("mean_ch4"))
    return (edges.join(counts, "bin", "left")
            .select("bin", "bin_lo", "bin_hi", F.coalesce("pixel_count", F.lit(0)).cast("long").alias("pixel_count"),
                    "mean_ch4")
            .orderBy("bin"))


def facility_preview(fac: DataFrame, n: int = 1000) -> DataFrame:
    """T4 + F5: a stable preview of located facility rows (first ``n`` by row_id)."""
    return (not_null(fac, "latitude", "longitude").select("row_id", "latitude", "longitude")
            .orderBy("row_id").limit(n))
