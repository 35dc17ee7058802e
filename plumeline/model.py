"""Table schemas and model constants."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# These must equal the published model settings for results to agree.
# ---------------------------------------------------------------------------------------------
QA_BRONZE = 0.1            # permissive ingest threshold
QA_SILVER = 0.5            # analysis threshold
QA_GOLD = 0.7              # reporting threshold
CH4_MIN_VALID = 1700.0     # ppb
CH4_MAX_VALID = 2100.0     # ppb
BBOX = {"min_lon": -120.0, "min_lat": 49.0, "max_lon": -110.0, "max_lat": 60.0}
FACILITY_BUFFER_M = 10000.0
GRID_DEG = 0.1
HEATMAP_GRID_DEG = 0.05
SEASON_FIRST_MONTH = 6
SEASON_LAST_MONTH = 8
RETENTION_DAYS = 365
MIN_PIXELS_PER_CELL = 5
AUDIT_AVG_QA_MIN = 0.3
AUDIT_AVG_CH4_MIN = 1750.0
AUDIT_AVG_CH4_MAX = 1950.0
AUDIT_MIN_ROWS = 1000
AUDIT_MIN_ORBITS = 3
CITY_LAT = 51.0447
CITY_LON = -114.0719
CITY_RADIUS_M = 50000.0
HIST_BINS = 50
PROCESSING_LEVEL = "L2"
PRODUCT_VERSION = "v02"
# Survey grid: township/range/section/LSD geometry and meridian base longitudes.
SURVEY_BASE_LAT = 49.0
MERIDIAN_BASE_LON = {4: -110.0, 5: -114.0, 6: -118.0}
MILE_M = 1609.344
METERS_PER_DEG_LAT = 111320.0
# Legal-location text forms and file-name tags.
DASHED_LOCATION_RE = r"^(\d{1,2})-(\d{1,2})-(\d{1,3})-(\d{1,2})([WE])(\d)$"
COMPACT_LOCATION_RE = r"^(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$"
REPORT_MONTH_RE = r"(\d{4})[_-](\d{2})"
ORBIT_IN_NAME_RE = r"_(\d{8}T\d{6})_(\d{8}T\d{6})_(\d{5,6})_"
REQUIRED_CSV_COLUMN = "BTY LOCATION EDIT"
# Source CSV header names mapped to normalized column names; the second "BTY" column is the
# facility description.
BATTERY_CSV_COLUMNS = [
    ("BATTERY", "facility_id"),
    ("LICENCE", "licence"),
    ("OPERATOR", "operator"),
    ("BTY", "facility_type"),
    ("BTY", "facility_description"),
    ("BTY LOCATION EDIT", "bty_location_raw"),
    ("OIL PROD", "oil_prod_m3"),
    ("GAS PROD", "gas_prod_1000m3"),
    ("GAS FLARED", "gas_flared_1000m3"),
    ("GAS VENTED", "gas_vented_1000m3"),
    ("WTR PROD", "water_prod_m3"),
    ("TOTAL", "total_wells"),
]
# Table names.
TABLE_FACILITIES = "bronze.aer_battery_monthly"
TABLE_PIXELS = "bronze.sentinel5p_raw"
TABLE_PIXELS_SILVER = "silver.sentinel5p_ch4_cleaned"
TABLE_HOTSPOTS = "gold.regional_ch4_hotspots"
# ---------------------------------------------------------------------------------------------

# Our choices (not published by the reference).
EARTH_RADIUS_M = 6371000.0
DEG2RAD = 0.017453292519943295  # pi / 180 as a double literal, identical in every engine

FACILITY_SCHEMA = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("facility_id", T.StringType()),
    T.StructField("licence", T.StringType()),
    T.StructField("operator", T.StringType()),
    T.StructField("facility_type", T.StringType()),
    T.StructField("facility_description", T.StringType()),
    T.StructField("reporting_month", T.DateType()),
    T.StructField("ingestion_date", T.DateType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("bty_location_raw", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("oil_prod_m3", T.DoubleType()),
    T.StructField("gas_prod_1000m3", T.DoubleType()),
    T.StructField("gas_flared_1000m3", T.DoubleType()),
    T.StructField("gas_vented_1000m3", T.DoubleType()),
    T.StructField("water_prod_m3", T.DoubleType()),
    T.StructField("total_wells", T.IntegerType()),
    T.StructField("load_no", T.LongType()),              # partition column (load of the ledger)
])

# Bronze pixels keep scanline / ground_pixel (the natural key) beside the published columns.
PIXEL_SCHEMA = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("measurement_timestamp", T.TimestampNTZType()),
    T.StructField("ch4_column", T.DoubleType()),
    T.StructField("ch4_column_precision", T.DoubleType()),
    T.StructField("qa_value", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("orbit_number", T.IntegerType()),
    T.StructField("processing_level", T.StringType()),
    T.StructField("product_version", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("scanline", T.LongType()),
    T.StructField("ground_pixel", T.LongType()),
    T.StructField("ingestion_timestamp", T.TimestampType()),
    T.StructField("measurement_date", T.DateType()),     # partition column (day of measurement)
    T.StructField("load_no", T.LongType()),              # partition column (load of the ledger)
])

# Partition columns of the bronze tables: date filters prune whole folders, and a load's rows are folders of their own.
FACILITY_PARTITIONS = ["reporting_month", "load_no"]
PIXEL_PARTITIONS = ["measurement_date", "load_no"]

# Granule blocks: up to a fixed number of scanlines of one swath file per row, [scanline][ground_pixel].
SWATH_POINT = T.StructType([
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("ch4", T.DoubleType()),
    T.StructField("qa", T.DoubleType()),
])
GRANULE_SCHEMA = T.StructType([
    T.StructField("orbit_attr", T.IntegerType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("first_scanline", T.LongType()),
    T.StructField("swath", T.ArrayType(T.ArrayType(SWATH_POINT))),
])

# Flattened swath rows (the interchange Parquet between granule decoding and the bronze load).
SWATH_PIXEL_SCHEMA = T.StructType([
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("ch4", T.DoubleType()),
    T.StructField("qa", T.DoubleType()),
    T.StructField("scanline", T.LongType()),
    T.StructField("ground_pixel", T.LongType()),
    T.StructField("orbit", T.IntegerType()),
    T.StructField("source_file", T.StringType()),
])
