"""Silver and gold tables (D1-D9). The reference only names these layers; the semantics here
are our own and are documented per function.

Deduplication keeps the row with the smallest (or largest) ordering key through ``min_by`` per
column (a hash aggregate) or ``min``/``max`` of a struct led by the ordering key (a sort aggregate,
used when a carried column is a string). Both aggregate partially on the map side, so a key with
millions of copies never meets in one task as rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumeline.functions.numeric import round_n
from plumeline.model import (FACILITY_BUFFER_M, MIN_PIXELS_PER_CELL, QA_GOLD, QA_SILVER, RETENTION_DAYS,
                             SEASON_FIRST_MONTH, SEASON_LAST_MONTH)
from plumeline.operators.filters import ch4_in_range, qa_at_least
from plumeline.operators.spatial import distance_inner_join


def _n():
    return F.count(F.lit(1))


PIXEL_KEY = ("file_path", "scanline", "ground_pixel")


_FIXED_WIDTH = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                T.DateType, T.TimestampType, T.TimestampNTZType)


def dedupe_keep_min(df: DataFrame, key: list, order_col: str) -> DataFrame:
    """One row per ``key``: the row with the smallest ``order_col`` (assumed unique per key).

    When every carried column is fixed-width this is ``min_by(column, order_col)`` per column,
    which Spark runs as a hash aggregate; otherwise ``min`` of a struct led by ``order_col``
    (a sort-based aggregate). Both aggregate partially before the shuffle.
    """
    rest = [c for c in df.columns if c not in key and c != order_col]
    types = {f.name: f.dataType for f in df.schema.fields}
    if all(isinstance(types[c], _FIXED_WIDTH) for c in rest):
        aggs = [F.min(order_col).alias(order_col)] + [F.min_by(c, order_col).alias(c) for c in rest]
        return df.groupBy(*key).agg(*aggs).select(*df.columns)
    agg = df.groupBy(*key).agg(F.min(F.struct(order_col, *rest)).alias("_r"))
    return agg.select(*key, *[F.col("_r." + c).alias(c) for c in [order_col] + rest]).select(*df.columns)


def silver_pixels(pix: DataFrame, newest: Column | None = None) -> DataFrame:
    """D1 + D7 + D8: the last 365 days before the newest measurement of the input, qa >= 0.5, CH4 in the valid
    range, one row per (file, scanline, ground_pixel) keeping the lowest row_id, and a flag for the
    preferred June-August season.

    Retention comes first: older rows are not deduplicated at all (of copies with different times only
    those inside the window compete), and on a table partitioned by ``measurement_date`` it prunes folders.
    ``newest`` is the newest measurement to count from, if ``pix`` is only a part of the table.
    """
    cols = ["row_id", "measurement_timestamp", "ch4_column", "qa_value", "latitude", "longitude",
            "orbit_number", "file_path", "scanline", "ground_pixel"]
    recent = pix
    if "measurement_date" in pix.columns:                        # the partition column of the bronze table
        newest_day = pix.agg(F.max("measurement_date")).scalar() if newest is None else F.to_date(newest)
        recent = pix.where(F.col("measurement_date") >= F.date_sub(newest_day, RETENTION_DAYS))
    newest = recent.agg(F.max("measurement_timestamp")).scalar() if newest is None else newest
    recent = recent.where(F.col("measurement_timestamp") >= newest - F.expr(f"INTERVAL {RETENTION_DAYS} DAYS"))
    s = dedupe_keep_min(ch4_in_range(qa_at_least(recent, QA_SILVER)).select(*cols), list(PIXEL_KEY), "row_id")
    month = F.month("measurement_timestamp")
    return s.withColumn("in_preferred_season", month.between(SEASON_FIRST_MONTH, SEASON_LAST_MONTH))


def preferred_season(silver: DataFrame) -> DataFrame:
    """D7 as a filter: pixels measured in the preferred June-August season."""
    return silver.where(F.col("in_preferred_season"))


def gold_pixels(pix: DataFrame) -> DataFrame:
    """Reporting quality (qa >= 0.7)."""
    return qa_at_least(pix, QA_GOLD)


def facility_dim(fac: DataFrame) -> DataFrame:
    """D3: one row per facility_id with the attributes of its latest report (month, then row_id)."""
    attrs = ["operator", "licence", "facility_type", "facility_description", "latitude", "longitude"]
    g = fac.groupBy("facility_id").agg(
        F.max(F.struct("reporting_month", "row_id", *attrs)).alias("_r"),
        F.min("reporting_month").alias("first_reporting_month"),
        _n().alias("n_reports"))
    return g.select("facility_id", *[F.col("_r." + a).alias(a) for a in attrs],
                    "first_reporting_month", F.col("_r.reporting_month").alias("last_reporting_month"),
                    "n_reports")


def battery_fact(fac: DataFrame) -> DataFrame:
    """One row per (facility_id, reporting_month), the latest load: by ingestion date, then by the load number of the
    ledger (where the table has one; a corrected file of the same day wins wherever its lines are), then row_id."""
    load = ["load_no"] if "load_no" in fac.columns else []
    vols = ["oil_prod_m3", "gas_prod_1000m3", "gas_flared_1000m3", "gas_vented_1000m3", "water_prod_m3",
            "total_wells"]
    g = fac.groupBy("facility_id", "reporting_month").agg(
        F.max(F.struct("ingestion_date", *load, "row_id", *vols)).alias("_r"), _n().alias("n_rows"))
    return g.select("facility_id", "reporting_month", F.col("_r.row_id").alias("row_id"),
                    *[F.col("_r." + v).alias(v) for v in vols], "n_rows")


def facility_pixel_agg(pix: DataFrame, fac: DataFrame, radius_m: float = FACILITY_BUFFER_M) -> DataFrame:
    """Per 0.1-degree pixel centre and measurement month: pixels, mean CH4, facilities within
    ``radius_m`` of the centre and the nearest one (km). Pixels are aggregated before the join."""
    lat_c, lon_c = round_n("latitude", 1).alias("lat_center"), round_n("longitude", 1).alias("lon_center")
    month = F.to_date(F.date_trunc("month", "measurement_timestamp")).alias("month")
    per_cm = pix.groupBy(lat_c, lon_c, month).agg(_n().alias("n_pixels"), F.sum("ch4_column").alias("_sum"))
    # The pixels are read once: the months travel with their centre through the join, as a part of its key.
    centres = per_cm.groupBy("lat_center", "lon_center").agg(F.collect_list(F.struct("month", "n_pixels", "_sum")).alias("months"))
    fac_pts = fac.select("facility_id", "latitude", "longitude").dropna().distinct()
    pairs = distance_inner_join(centres, fac_pts, radius_m, "lat_center", "lon_center", "latitude", "longitude")
    per_centre = pairs.groupBy("lat_center", "lon_center", "months").agg(
        F.count_distinct("r_facility_id").alias("n_facilities"), F.min("distance_m").alias("_near"))
    return per_centre.select("lat_center", "lon_center", "n_facilities", "_near", F.inline("months")).select(
        "lat_center", "lon_center", "month", "n_pixels",
        (F.col("_sum") / F.col("n_pixels")).alias("mean_ch4"),
        "n_facilities", round_n(F.col("_near") / F.lit(1000.0), 3).alias("nearest_km"))


def ch4_hotspots(pix: DataFrame, min_pixels: int = MIN_PIXELS_PER_CELL) -> DataFrame:
    """D2 + D6: gold pixels on the 0.1-degree grid, cells with at least ``min_pixels``, mean CH4,
    enhancement over the regional gold mean, ranked. The ranking window sees one row per cell;
    bronze pixels lie in the bbox, so there are at most 111 x 101 cells."""
    gold = gold_pixels(pix)
    cells = (gold.groupBy(round_n("latitude", 1).alias("lat_grid"), round_n("longitude", 1).alias("lon_grid"))
             .agg(_n().alias("n_pixels"), F.avg("ch4_column").alias("avg_ch4"))
             .where(F.col("n_pixels") >= F.lit(min_pixels)))
    regional = gold.agg(F.avg("ch4_column")).scalar()
    ranked = cells.withColumn("enhancement", round_n(F.col("avg_ch4") - regional, 4))
    return ranked.withColumn("hotspot_rank", F.rank().over(Window.orderBy(F.col("avg_ch4").desc())).cast("long"))


def cell_states(pix: DataFrame, *by: str) -> DataFrame:
    """Mergeable state of the hotspot cells: gold pixels and their CH4 sum per 0.1-degree cell (and ``by``, e.g. the day)."""
    return gold_pixels(pix).groupBy(*by, round_n("latitude", 1).alias("lat_grid"), round_n("longitude", 1).alias("lon_grid")).agg(
        F.count("ch4_column").alias("n"), F.sum("ch4_column").alias("s"), _n().alias("n_pixels"))


def hotspots_of(states: DataFrame, min_pixels: int = MIN_PIXELS_PER_CELL) -> DataFrame:
    """D6 from cell states of any parts of the table: the same rows as ``ch4_hotspots`` over all their pixels."""
    cells = states.groupBy("lat_grid", "lon_grid").agg(F.sum("n_pixels").alias("n_pixels"), F.sum("n").alias("n"), F.sum("s").alias("s"))
    regional = states.agg(F.sum("s") / F.sum("n")).scalar()
    found = cells.where(F.col("n_pixels") >= F.lit(min_pixels)).select(
        "lat_grid", "lon_grid", "n_pixels", (F.col("s") / F.col("n")).alias("avg_ch4"))
    ranked = found.withColumn("enhancement", round_n(F.col("avg_ch4") - regional, 4))
    return ranked.withColumn("hotspot_rank", F.rank().over(Window.orderBy(F.col("avg_ch4").desc())).cast("long"))


def enhancement_vs_activity(pix: DataFrame, fac: DataFrame, radius_m: float = FACILITY_BUFFER_M) -> DataFrame:
    """Per facility and month, CH4 of the pixel centres within ``radius_m`` (mean, and enhancement over the
    regional mean of the month) beside the activity reported for that month (flared + vented gas, produced gas
    and their ratio)."""
    month = F.to_date(F.date_trunc("month", "measurement_timestamp")).alias("month")
    per_centre = (pix.groupBy(round_n("latitude", 1).alias("lat_center"), round_n("longitude", 1).alias("lon_center"), month)
                  .agg(_n().alias("n"), F.sum("ch4_column").alias("s")))
    # The pixels are read once: a window sees one row per centre of a month, and the months travel with their centre.
    of_month = Window.partitionBy("month")
    regional = (F.sum("s").over(of_month) / F.sum("n").over(of_month)).alias("regional_mean")
    centres = per_centre.select("*", regional).groupBy("lat_center", "lon_center").agg(
        F.collect_list(F.struct("month", "n", "s", "regional_mean")).alias("months"))
    fac_pts = fac.select("facility_id", "latitude", "longitude").dropna().distinct()
    pairs = distance_inner_join(fac_pts, centres, radius_m, "latitude", "longitude", "lat_center", "lon_center")
    pairs = pairs.select("facility_id", "r_lat_center", "r_lon_center", "r_months").distinct()
    near = pairs.select("facility_id", F.inline("r_months")).groupBy("facility_id", "month").agg(
        _n().alias("n_centres"), F.sum("n").alias("n_pixels_near"), F.sum("s").alias("_s"), F.max("regional_mean").alias("regional_mean"))
    emitted = F.col("gas_flared_1000m3") + F.col("gas_vented_1000m3")
    activity = battery_fact(fac).select("facility_id", F.col("reporting_month").alias("month"), emitted.alias("emitted_1000m3"),
                                        F.col("gas_prod_1000m3").alias("produced_1000m3"))
    mean_near = F.col("_s") / F.col("n_pixels_near")
    return near.join(activity, ["facility_id", "month"]).select(
        "facility_id", "month", "n_centres", "n_pixels_near", round_n(mean_near, 3).alias("mean_ch4_near"),
        round_n(mean_near - F.col("regional_mean"), 3).alias("enhancement"), "emitted_1000m3", "produced_1000m3",
        round_n(F.col("emitted_1000m3") / F.nullif(F.col("produced_1000m3"), F.lit(0.0)), 6).alias("emission_ratio"))


def activity_correlation(pairs: DataFrame) -> DataFrame:
    """Per month, facilities with both sides and the correlation of enhancement and emitted gas."""
    return pairs.groupBy("month").agg(
        F.count_if(F.col("enhancement").isNotNull() & F.col("emitted_1000m3").isNotNull()).alias("n_facilities"),
        round_n(F.corr("enhancement", "emitted_1000m3"), 6).alias("correlation"))


def write_silver(spark, source_table: str = "bronze.sentinel5p_raw",
                 target_table: str = "silver.sentinel5p_ch4_cleaned") -> dict:
    """Rebuild the silver pixel table from bronze, partitioned by measurement day."""
    from plumeline.sources.tables import create_layers
    create_layers(spark)
    silver = silver_pixels(spark.table(source_table)).withColumn("day", F.to_date("measurement_timestamp"))
    # One shuffle by day first: a task then writes few days, not every task a file per day.
    silver.repartition("day").write.mode("overwrite").format("parquet").partitionBy("day").saveAsTable(target_table)
    return {"table": target_table, "rows": spark.table(target_table).count()}


def write_facility_tables(spark, pixels: str = "bronze.sentinel5p_raw", facilities: str = "bronze.aer_battery_monthly") -> list[dict]:
    """Rebuild the silver facility dimension, battery fact and facility-pixel aggregate from bronze."""
    from plumeline.sources.tables import create_layers
    create_layers(spark)
    fac, out = spark.table(facilities), []
    for name, df in (("silver.facility_dim", facility_dim(fac)), ("silver.battery_fact", battery_fact(fac)),
                     ("silver.facility_pixel_agg", facility_pixel_agg(spark.table(pixels), fac))):
        df.write.mode("overwrite").format("parquet").saveAsTable(name)
        out.append({"table": name, "rows": spark.table(name).count()})
    return out


def write_hotspots(spark, source_table: str = "bronze.sentinel5p_raw",
                   target_table: str = "gold.regional_ch4_hotspots") -> dict:
    """Rebuild the gold hotspot table (one row per qualifying 0.1-degree cell)."""
    from plumeline.sources.tables import create_layers
    create_layers(spark)
    ch4_hotspots(spark.table(source_table)).write.mode("overwrite").format("parquet").saveAsTable(target_table)
    return {"table": target_table, "rows": spark.table(target_table).count()}
