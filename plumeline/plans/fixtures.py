"""Fixture views over the driver tables (see FIXTURES.md).

``pixels`` (from events) and ``batteries`` (from orders) are plain SQL that Spark and DuckDB run
unchanged; ``{events}`` / ``{orders}`` name the source table. ``granules`` nests pixels into swath
blocks (Spark only). The bronze builders apply what the ingest applies: bbox and validity filters
for pixels; geocoding and the unlocated-row drop for facilities.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumeline.functions.location import with_location
from plumeline.functions.numeric import nan_to_null
from plumeline.operators.filters import in_bbox, valid_pixels

PIXELS_SQL = """
select event_id as row_id, ts + (event_id % 20) * interval '30' day as measurement_timestamp,
  case when event_id % 17 = 0 then null
       else cast(1650 + (event_id * 37) % 500 as double) + cast(event_id % 8 as double) / 8 end as ch4_column,
  cast(null as double) as ch4_column_precision,
  cast((event_id * 13) % 101 as double) / 100 as qa_value,
  case when event_id % 20 = 7 then 54.0e0 + cast(event_id % 3 as double) / 10.0e0 + 0.013e0
       else 48 + cast((event_id * 7919) % 130003 as double) / 10000.25e0 end as latitude,
  case when event_id % 20 = 7 then -115.0e0 - cast(event_id % 4 as double) / 10.0e0 - 0.013e0
       else -121 + cast((event_id * 104729) % 120011 as double) / 10000.75e0 end as longitude,
  cast(36000 + event_id % 16 as int) as orbit_number,
  'L2' as processing_level, 'v02' as product_version,
  cast(floor(event_id / 320e0) as int) as scanline,
  cast(floor(event_id / 16e0) as int) % 20 as ground_pixel,
  concat('S5P_OFFL_L2__CH4____20240114T183522_20240114T201652_',
         cast(36000 + event_id % 16 as string), '_03_020800_X.nc') as file_path
from {events}
"""

BATTERIES_SQL = """
select o_orderkey as row_id,
  concat('ABBT', lpad(cast(o_custkey as string), 6, '0')) as facility_id,
  concat('F', cast(o_custkey % 700 as string)) as licence,
  case when o_custkey % 23 = 0 then null
       else concat('OPERATOR_', cast(o_custkey % 40 as string)) end as operator,
  concat('T', cast(o_custkey % 5 as string)) as facility_type,
  concat('type ', cast(o_custkey % 5 as string)) as facility_description,
  make_date(2024 + cast(floor(((year(o_orderdate) * 12 + month(o_orderdate)) % 20) / 12e0) as int),
            cast((year(o_orderdate) * 12 + month(o_orderdate)) % 20 % 12 as int) + 1, 1) as reporting_month,
  case when o_custkey % 17 = 1 then concat(chr(160), loc, chr(9)) when o_custkey % 19 = 1 then concat(' ', loc, chr(9))
       else loc end as bty_location_raw,
  case when o_orderkey % 29 = 0 then null else cast(o_orderkey % 4096 as double) / 8 end as gas_prod_1000m3,
  case when o_orderkey % 31 = 0 then null else cast((o_orderkey * 7) % 256 as double) / 8 end as gas_flared_1000m3,
  cast((o_orderkey * 3) % 128 as double) / 8 as gas_vented_1000m3,
  cast((o_orderkey * 5) % 512 as double) / 8 as oil_prod_m3,
  cast((o_orderkey * 11) % 512 as double) / 8 as water_prod_m3,
  cast(o_orderkey % 60 as int) as total_wells,
  case when o_orderkey % 29 = 0 then 'n/a' when o_orderkey % 37 = 0 then '1,234'
       when o_orderkey % 41 = 0 then '12d' when o_orderkey % 43 = 0 then ' 12 '
       when o_orderkey % 47 = 0 then '1e3' when o_orderkey % 53 = 0 then ''
       else cast(o_orderkey % 4096 as string) end as gas_prod_text
from (select *,
  case when o_custkey % 11 = 0 then ''
       when o_custkey % 13 = 0 then 'UNKNOWN'
       when o_custkey % 3 = 0 then concat(
         lpad(cast(4 + o_custkey % 3 as string), 2, '0'), lpad(cast(1 + (o_custkey * 31) % 99 as string), 2, '0'),
         lpad(cast(1 + (o_custkey * 17) % 34 as string), 2, '0'), lpad(cast(1 + o_custkey % 36 as string), 2, '0'),
         lpad(cast(1 + o_custkey % 16 as string), 2, '0'))
       else concat(
         lpad(cast(1 + o_custkey % 16 as string), 2, '0'), '-', lpad(cast(1 + o_custkey % 36 as string), 2, '0'), '-',
         lpad(cast(1 + (o_custkey * 31) % 126 as string), 3, '0'), '-',
         lpad(cast(1 + (o_custkey * 17) % 34 as string), 2, '0'), 'W', cast(4 + o_custkey % 3 as string))
       end as loc
  from {orders}) o
"""

# Swath blocks of GRANULE_BLOCK scanlines per file (Spark only). Orbits with orbit % 8 = 7 get a
# file name without an orbit tag (attribute fallback), orbits with orbit % 8 = 3 have neither tag nor attribute
# (their pixels stay, without an orbit); two granules without swath data are appended.
GRANULE_BLOCK = 64
GRANULES_SQL = """
select orbit_attr, file_path, cast(blk * {block} as long) as first_scanline,
  transform(sort_array(collect_list(named_struct('sl', sl, 'line', line))), x -> x.line) as swath
from (
  select case when orbit_number % 8 = 3 then null else orbit_number end as orbit_attr,
    case when orbit_number % 8 in (3, 7) then concat('granule_', cast(orbit_number as string), '.nc') else file_path end as file_path,
    cast(floor(scanline / {block}) as int) as blk,
    scanline as sl,
    transform(sort_array(collect_list(named_struct('gp', ground_pixel, 'time', measurement_timestamp, 'lat', latitude,
      'lon', longitude, 'ch4', ch4_column, 'qa', qa_value))),
      p -> named_struct('time', p.time, 'lat', p.lat, 'lon', p.lon, 'ch4', p.ch4, 'qa', p.qa)) as line
  from {pixels} group by orbit_number, file_path, scanline)
group by orbit_attr, file_path, blk
union all select 36100, 'missing_variable.nc', cast(0 as long),
  cast(null as array<array<struct<time:timestamp_ntz,lat:double,lon:double,ch4:double,qa:double>>>)
union all select cast(null as int), 'no_orbit_anywhere.nc', cast(0 as long),
  cast(null as array<array<struct<time:timestamp_ntz,lat:double,lon:double,ch4:double,qa:double>>>)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PIXELS_SQL, events=table(spark, sf_dir, "events"))


def batteries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BATTERIES_SQL, orders=table(spark, sf_dir, "orders"))


def granules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(GRANULES_SQL.replace("{block}", str(GRANULE_BLOCK)), pixels=pixels(spark, sf_dir))


def bronze_pixels(pix: DataFrame) -> DataFrame:
    """Landing pixel rows -> bronze content: NaN as NULL, inside the bbox, valid."""
    cleaned = pix
    for c in ("ch4_column", "qa_value", "latitude", "longitude"):
        cleaned = cleaned.withColumn(c, nan_to_null(F.col(c)))
    return valid_pixels(in_bbox(cleaned))


def with_source_file(bat: DataFrame) -> DataFrame:
    """Monthly file each fixture row stands for (``ST60_YYYY-MM.csv``)."""
    return bat.withColumn("source_file", F.concat(F.lit("ST60_"), F.date_format("reporting_month", "yyyy-MM"),
                                                  F.lit(".csv")))


def geocoded_facilities(bat: DataFrame, mode: str = "as_written", located_only: bool = False) -> DataFrame:
    """Battery rows with latitude / longitude (NULL where the location does not parse)."""
    return with_source_file(with_location(bat, "bty_location_raw", mode, located_only=located_only))


def bronze_facilities(bat: DataFrame, mode: str = "as_written") -> DataFrame:
    """Bronze facility content: located rows only, with an ingestion date."""
    return geocoded_facilities(bat, mode, located_only=True).withColumn("ingestion_date", F.current_date())
