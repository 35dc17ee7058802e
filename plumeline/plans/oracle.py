"""Plain-SQL statements of every catalogue query, for DuckDB over the same Parquet tables.

They spell out the brute-force semantics (nested-loop distance tests, global row_number, window
dedupes), independent of the DataFrame code. Float literals carry ``e0`` so DuckDB reads DOUBLE.
"""

from __future__ import annotations

from plumeline.model import DEG2RAD, EARTH_RADIUS_M, METERS_PER_DEG_LAT
from plumeline.functions.location import LSD_M, SECTION_M, TOWNSHIP_M
from plumeline.functions.numeric import NUMERIC_TEXT_RE
from plumeline.plans.fixtures import GRANULE_BLOCK, BATTERIES_SQL, PIXELS_SQL


# Written from the published rules, not taken from the code under test.
DASHED_LOCATION_RE = "^([0-9][0-9]?)-([0-9][0-9]?)-([0-9][0-9]?[0-9]?)-([0-9][0-9]?)([WE])([0-9])$"
COMPACT_LOCATION_RE = "^[0-9]{10}$"
BLANKS = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ' || chr(133) || chr(160) || chr(8195) || chr(12288)"


def _f(x: float) -> str:
    return repr(float(x)) + "e0" if "e" not in repr(float(x)) else repr(float(x))


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    k = _f(DEG2RAD)
    s1 = f"sin(({lat2} - {lat1}) * {k} / 2.0e0)"
    s2 = f"sin(({lon2} - {lon1}) * {k} / 2.0e0)"
    a = f"{s1} * {s1} + cos({lat1} * {k}) * cos({lat2} * {k}) * {s2} * {s2}"
    return f"({_f(2 * EARTH_RADIUS_M)} * asin(least(1.0e0, sqrt({a}))))"


def _geocode_cte(name: str, mode: str) -> str:
    if mode == "as_written":
        c = {"mer": (1, 2), "twp": (3, 2), "rng": (5, 2), "sec": (7, 2), "lsd": (9, 2)}
    else:
        c = {"twp": (1, 3), "mer": (4, 1), "rng": (5, 2), "sec": (7, 2), "lsd": (9, 2)}
    d_grp = {"lsd": 1, "sec": 2, "twp": 3, "rng": 4, "mer": 6}
    fields = ",\n      ".join(
        f"case when is_d then cast(regexp_extract(v, '{DASHED_LOCATION_RE}', {d_grp[k]}) as int) "
        f"when is_c then cast(substr(v, {c[k][0]}, {c[k][1]}) as int) end as {k}" for k in d_grp)
    twp = "twp" if mode == "as_written" else "(twp - 1)"
    rng = "rng" if mode == "as_written" else "(rng - 1)"
    lsd_col = ("((lsd - 1) % 4)" if mode == "as_written" else
               "(case when ((lsd - 1) // 4) % 2 = 1 then 3 - (lsd - 1) % 4 else (lsd - 1) % 4 end)")
    sec_col = "(case when ((sec - 1) // 6) % 2 = 1 then 5 - (sec - 1) % 6 else (sec - 1) % 6 end)"
    T, S, L = _f(TOWNSHIP_M), _f(SECTION_M), _f(LSD_M)
    per_deg = f"({_f(METERS_PER_DEG_LAT)} * cos(lat_raw * {_f(DEG2RAD)}))"
    return f"""{name}_parts as (
  select *,
      {fields},
      case when is_d then regexp_extract(v, '{DASHED_LOCATION_RE}', 5) when is_c then 'W' end as dir
  from (select *, regexp_matches(v, '{DASHED_LOCATION_RE}') as is_d, regexp_matches(v, '{COMPACT_LOCATION_RE}') as is_c
        from (select *, nullif(nullif(upper(trim(bty_location_raw, {BLANKS})), ''), 'NAN') as v from batteries) v0) v1),
{name}_raw as (
  select *, 49.0e0 + north / {_f(METERS_PER_DEG_LAT)} as lat_raw from (
    select *,
      {twp} * {T} + ((sec - 1) // 6) * {S} + ((lsd - 1) // 4) * {L} as north,
      {rng} * {T} + {sec_col} * {S} + {lsd_col} * {L} as west,
      case mer when 4 then -110.0e0 when 5 then -114.0e0 when 6 then -118.0e0 end as base_lon,
      (lsd between 1 and 16 and sec between 1 and 36 and twp between 1 and 126 and rng between 1 and 34
       and mer in (4, 5, 6) and dir in ('W', 'E')) as ok
    from {name}_parts) p),
{name} as (
  select row_id, facility_id, licence, operator, facility_type, facility_description, reporting_month,
    bty_location_raw, gas_prod_1000m3, gas_flared_1000m3, gas_vented_1000m3, oil_prod_m3, water_prod_m3,
    total_wells, gas_prod_text,
    case when ok then round(lat_raw, 6) end as latitude,
    case when ok then round(case when dir = 'W' then base_lon - west / {per_deg} else base_lon + west / {per_deg} end, 6)
      end as longitude,
    'ST60_' || strftime(reporting_month, '%Y-%m') || '.csv' as source_file
  from {name}_raw)"""


BASE = f"""with pixels as ({PIXELS_SQL.replace('{events}', 'events')}),
batteries as ({BATTERIES_SQL.replace('{orders}', 'orders')}),
bronze_pix as (
  select * from pixels
  where latitude between 49.0e0 and 60.0e0 and longitude between -120.0e0 and -110.0e0
    and ch4_column is not null and latitude is not null and longitude is not null and qa_value >= 0.1e0
    and measurement_timestamp is not null and scanline is not null and ground_pixel is not null),
{_geocode_cte('geo', 'as_written')},
{_geocode_cte('geo_fixed', 'corrected')},
fac as (select * from geo where latitude is not null and longitude is not null),
centres as (select round(latitude, 1) as lat_center, round(longitude, 1) as lon_center, count(*) as n_pixels
            from bronze_pix group by 1, 2),
fac_pts as (select distinct latitude, longitude from fac),
near_centres as (
  select lat_center, lon_center, n_pixels from centres c
  where exists (select 1 from fac_pts f where {hav('c.lat_center', 'c.lon_center', 'f.latitude', 'f.longitude')} <= 10000.0e0)),
bfact as (
  select * from (select *, row_number() over (partition by facility_id, reporting_month order by row_id desc) as rn,
                        count(*) over (partition by facility_id, reporting_month) as n_rows from fac) x where rn = 1)
"""

CITY = hav("latitude", "longitude", "51.0447e0", "-114.0719e0")

Q: dict[str, str] = {}

Q["geocode_batteries"] = """
select row_id, facility_id, bty_location_raw, latitude, longitude from geo
where latitude is not null and longitude is not null"""

Q["geocode_batteries_corrected"] = """
select row_id, facility_id, bty_location_raw, latitude, longitude from geo_fixed
where latitude is not null and longitude is not null"""

Q["numeric_coercion"] = f"""
select row_id, gas_prod_text, v as gas_prod_value,
  case when v = floor(v) and abs(v) <= 2147483647.0e0 then cast(v as int) end as gas_prod_int
from (select row_id, gas_prod_text,
        case when regexp_matches(trim(gas_prod_text), '{NUMERIC_TEXT_RE}') then try_cast(trim(gas_prod_text) as double) end as v
      from batteries) t"""

Q["pixel_filter_bronze"] = """
select row_id, measurement_timestamp, ch4_column, qa_value, latitude, longitude, orbit_number, scanline,
  ground_pixel, file_path from bronze_pix"""

Q["swath_flatten"] = """
select measurement_timestamp as time, latitude as lat, longitude as lon, ch4_column as ch4, qa_value as qa,
  cast(scanline as bigint) as scanline, cast(ground_pixel as bigint) as ground_pixel,
  case when orbit_number % 8 <> 3 then orbit_number end as orbit,
  case when orbit_number % 8 in (3, 7) then 'granule_' || cast(orbit_number as varchar) || '.nc' else file_path end as source_file
from bronze_pix"""

Q["rejected_granules"] = f"""
, files as (
  select case when orbit_number % 8 in (3, 7) then 'granule_' || cast(orbit_number as varchar) || '.nc' else file_path end as file_path,
    max(case when orbit_number % 8 <> 3 then orbit_number end) as orbit, count(distinct floor(scanline / {GRANULE_BLOCK}e0)) as blocks
  from pixels group by 1),
kept as (
  select case when orbit_number % 8 in (3, 7) then 'granule_' || cast(orbit_number as varchar) || '.nc' else file_path end as file_path,
    count(*) as pixels_kept
  from bronze_pix group by 1)
select f.file_path, f.orbit, f.blocks, coalesce(k.pixels_kept, 0) as pixels_kept,
  case when coalesce(k.pixels_kept, 0) = 0 then 'empty' else 'loaded' end as status,
  case when f.orbit is null then 'no_orbit' end as note
from files f left join kept k using (file_path)
union all select 'missing_variable.nc', 36100, 1, 0, 'missing_variable', null
union all select 'no_orbit_anywhere.nc', cast(null as int), 1, 0, 'missing_variable', 'no_orbit'"""

Q["append_row_ids"] = """
, b as (select file_path, scanline, ground_pixel,
               case when day(measurement_timestamp) <= 15 then 1 else 2 end as load_batch from bronze_pix)
select row_number() over (partition by load_batch order by file_path, scanline, ground_pixel)
         + case when load_batch = 2 then (select count(*) from b where load_batch = 1) else 0 end as row_id,
       load_batch, file_path, scanline, ground_pixel
from b"""

Q["ids_after_retention"] = """
, b as (select file_path, scanline, ground_pixel, measurement_timestamp,
               case when day(measurement_timestamp) <= 15 then 1 else 2 end as load_batch from bronze_pix),
loaded as (select *, row_number() over (partition by load_batch order by file_path, scanline, ground_pixel) as own from b)
select case when load_batch = 2 then (select max(own) from loaded where load_batch = 1) else 0 end + own as row_id,
       load_batch, file_path, scanline, ground_pixel
from loaded
where load_batch = 2 or measurement_timestamp >= (select max(measurement_timestamp) from b where load_batch = 1) - interval '30' day"""

Q["retained_pixels"] = """
select row_id, measurement_timestamp, ch4_column, file_path, scanline, ground_pixel from bronze_pix
where measurement_timestamp >= (select max(measurement_timestamp) from bronze_pix) - interval '365' day"""

Q["file_row_numbers"] = """
select f as source_file, row_id, row_number() over (partition by f order by row_id) as file_row
from (select case when row_id % 97 <> 0 then source_file end as f, row_id from geo
      where latitude is not null and longitude is not null) t"""

Q["month_in_file_name"] = """
select row_id, file_name,
  case when file_name <> 'no_month_13.csv' then reporting_month end as reporting_month
from (select row_id, reporting_month,
        case row_id % 3 when 0 then 'ST60_' || strftime(reporting_month, '%Y_%m') || '.csv'
             when 1 then 'st60-' || strftime(reporting_month, '%Y-%m') || '_v2.csv' else 'no_month_13.csv' end as file_name
      from batteries) t"""

Q["typed_projection"] = """
select row_id, measurement_timestamp, ch4_column, ch4_column_precision, qa_value, latitude, longitude, orbit_number,
  processing_level, product_version, file_path, cast(scanline as bigint) as scanline, cast(ground_pixel as bigint) as ground_pixel,
  cast(measurement_timestamp as date) as measurement_date
from bronze_pix"""

Q["top_operators"] = """
select operator, count(*) as facility_count from fac where operator is not null
group by operator order by facility_count desc, operator limit 10"""

Q["facility_extent"] = """
select round(min(latitude), 2) as min_lat, round(max(latitude), 2) as max_lat,
  round(min(longitude), 2) as min_lon, round(max(longitude), 2) as max_lon,
  round(max(latitude) - min(latitude), 2) as lat_range, round(max(longitude) - min(longitude), 2) as lon_range
from fac"""

Q["pixel_extent"] = """
select round(min(latitude), 2) as min_lat, round(max(latitude), 2) as max_lat,
  round(min(longitude), 2) as min_lon, round(max(longitude), 2) as max_lon
from bronze_pix"""

Q["monthly_production"] = """
select reporting_month, count(*) as num_facilities,
  round(sum(gas_prod_1000m3), 1) as total_gas_prod_1000m3,
  round(sum(gas_flared_1000m3), 1) as total_gas_flared_1000m3,
  round(sum(gas_vented_1000m3), 1) as total_gas_vented_1000m3,
  round(sum(gas_flared_1000m3 + gas_vented_1000m3) / nullif(sum(gas_prod_1000m3), 0) * 100, 2) as pct_emissions
from fac where gas_prod_1000m3 > 0
group by reporting_month order by reporting_month"""

Q["pixel_coverage"] = """
select count(*) as total_rows, min(measurement_timestamp) as first_date, max(measurement_timestamp) as last_date,
  count(distinct cast(measurement_timestamp as date)) as unique_dates, count(distinct orbit_number) as unique_orbits
from bronze_pix"""

Q["qa_summary"] = """
select round(qa_value, 3) as avg_qa, high_quality, total,
  round(cast(high_quality as double) / nullif(total, 0) * 100.0e0, 2) as high_quality_pct,
  round(avg_ch4_raw, 2) as avg_ch4
from (select avg(qa_value) as qa_value, count(*) filter (where qa_value >= 0.3e0) as high_quality,
        count(*) as total, avg(ch4_column) as avg_ch4_raw from bronze_pix) t"""

Q["null_audit"] = """
select 'pixels_landing' as table_name, count(*) as total_rows,
  count(*) filter (where latitude is not null and longitude is not null) as rows_with_location,
  count(*) filter (where latitude is null or longitude is null) as rows_without_location
from pixels
union all
select 'batteries_geocoded', count(*),
  count(*) filter (where latitude is not null and longitude is not null),
  count(*) filter (where latitude is null or longitude is null)
from geo"""

Q["duplicate_audit"] = """
select count(*) as total_rows, count(*) - count(distinct row_id) as duplicate_row_ids,
  count(*) - count(distinct (file_path, scanline, ground_pixel)) as duplicate_natural_keys
from bronze_pix"""

Q["facilities_within_radius"] = f"""
select facility_id, operator, round(latitude, 4) as lat, round(longitude, 4) as lon,
  round({CITY} / 1000.0e0, 1) as distance_km
from fac where {CITY} <= 50000.0e0
order by distance_km, facility_id, row_id limit 10"""

Q["pixels_near_facilities"] = """
select lat_center, lon_center, n_pixels from near_centres"""

Q["overlap_summary"] = """
select total_pixels, total_facilities, pixels_near_facilities,
  round(cast(pixels_near_facilities as double) / nullif(total_pixels, 0) * 100.0e0, 2) as overlap_pct
from (select (select count(*) from centres) as total_pixels, (select count(*) from fac) as total_facilities,
             (select count(*) from near_centres) as pixels_near_facilities) t"""

Q["grid_mean_005"] = """
select round_even(latitude / 0.05e0, 0) * 0.05e0 as lat_grid, round_even(longitude / 0.05e0, 0) * 0.05e0 as lon_grid,
  avg(ch4_column) as avg_ch4, count(*) as n_pixels
from bronze_pix where qa_value >= 0.5e0 group by 1, 2"""

Q["grid_mean_01"] = """
select round(latitude, 1) as lat_grid, round(longitude, 1) as lon_grid, avg(ch4_column) as avg_ch4, count(*) as n_pixels
from bronze_pix where qa_value >= 0.5e0 group by 1, 2"""

Q["qa_histogram"] = """
select round(qa_value, 1) as qa_bin, count(*) as count from bronze_pix group by 1 order by 1"""

Q["ch4_histogram"] = """
, v as (select ch4_column from bronze_pix where ch4_column between 1700.0e0 and 2100.0e0),
s as (select min(ch4_column) as mn, max(ch4_column) as mx, avg(ch4_column) as mean from v),
bnd as (select case when mn = mx then mn - 0.5e0 else mn end as lo,
               case when mn = mx then mx + 0.5e0 else mx end as hi, mean from s where mn is not null),
c as (select cast(least(floor((ch4_column - lo) / (hi - lo) * 50.0e0) + 1, 50) as int) as bin, count(*) as pixel_count
      from v cross join bnd group by 1),
bins as (select cast(range as int) as bin from range(1, 51))
select bins.bin, lo + (hi - lo) * cast(bins.bin - 1 as double) / 50.0e0 as bin_lo,
  lo + (hi - lo) * cast(bins.bin as double) / 50.0e0 as bin_hi,
  coalesce(c.pixel_count, 0) as pixel_count, mean as mean_ch4
from bins cross join bnd left join c on bins.bin = c.bin order by 1"""

Q["facility_preview"] = """
select row_id, latitude, longitude from fac where latitude is not null and longitude is not null
order by row_id limit 1000"""

Q["audit_pixels"] = """
, m as (select count(*) as n, count(distinct orbit_number) as orbits,
          round(min(latitude), 2) as min_lat, round(max(latitude), 2) as max_lat,
          round(min(longitude), 2) as min_lon, round(max(longitude), 2) as max_lon,
          round(avg(qa_value), 3) as avg_qa, avg(ch4_column) as avg_ch4,
          count(*) filter (where latitude is null or longitude is null) as null_loc,
          count(*) - count(distinct row_id) as dups,
          (select count(*) from near_centres) as near
        from bronze_pix),
k as (select *, (49.0e0 <= min_lat and min_lat <= max_lat and max_lat <= 60.0e0
                 and -120.0e0 <= min_lon and min_lon <= max_lon and max_lon <= -110.0e0) as inside from m)
select 'row_count' as "check", cast(n as double) as value,
  case when n = 0 then 'FAILED' when n < 1000 then 'WARNING' else 'PASSED' end as status from k
union all select 'orbit_coverage', cast(orbits as double), case when orbits >= 3 then 'PASSED' else 'WARNING' end from k
union all select 'extent_in_bbox', cast(cast(inside as int) as double), case when inside then 'PASSED' else 'WARNING' end from k
union all select 'mean_qa', avg_qa, case when avg_qa >= 0.3e0 then 'PASSED' else 'WARNING' end from k
union all select 'mean_ch4', round(avg_ch4, 2),
  case when avg_ch4 between 1750.0e0 and 1950.0e0 then 'PASSED' else 'WARNING' end from k
union all select 'missing_location', cast(null_loc as double), case when null_loc = 0 then 'PASSED' else 'FAILED' end from k
union all select 'facility_overlap', cast(near as double), case when near >= 1 then 'PASSED' else 'WARNING' end from k
union all select 'duplicate_row_ids', cast(dups as double), case when dups = 0 then 'PASSED' else 'WARNING' end from k"""

Q["audit_facilities"] = f"""
, m as (select count(*) as n, round(min(latitude), 2) as min_lat, round(max(latitude), 2) as max_lat,
          count(*) filter (where latitude is null or longitude is null) as null_loc,
          (select count(*) from fac where {CITY} <= 50000.0e0) as near_city
        from fac),
k as (select *, (min_lat >= 49.0e0 and max_lat <= 60.0e0) as lat_ok from m)
select 'row_count' as "check", cast(n as double) as value, case when n = 0 then 'WARNING' else 'PASSED' end as status from k
union all select 'latitude_in_bbox', cast(cast(lat_ok as int) as double), case when lat_ok then 'PASSED' else 'WARNING' end from k
union all select 'missing_location', cast(null_loc as double), case when null_loc = 0 then 'PASSED' else 'WARNING' end from k
union all select 'facilities_near_city', cast(near_city as double), 'INFO' from k"""

_SILVER = """
, s as (select row_id, measurement_timestamp, ch4_column, qa_value, latitude, longitude, orbit_number, file_path,
          scanline, ground_pixel
        from bronze_pix where qa_value >= 0.5e0 and ch4_column between 1700.0e0 and 2100.0e0
          and measurement_timestamp >= (select max(measurement_timestamp) from bronze_pix) - interval 365 day),
silver as (
  select row_id, measurement_timestamp, ch4_column, qa_value, latitude, longitude, orbit_number, file_path, scanline,
    ground_pixel, month(measurement_timestamp) between 6 and 8 as in_preferred_season
  from (select *, row_number() over (partition by file_path, scanline, ground_pixel order by row_id) as rn from s) x where rn = 1)
"""

Q["silver_pixels"] = _SILVER + "select * from silver"

Q["preferred_season_pixels"] = _SILVER + "select row_id, measurement_timestamp, ch4_column from silver where in_preferred_season"

Q["facility_dim"] = """
select facility_id, operator, licence, facility_type, facility_description, latitude, longitude,
  first_reporting_month, reporting_month as last_reporting_month, n_reports
from (select *, row_number() over (partition by facility_id order by reporting_month desc, row_id desc) as rn,
        min(reporting_month) over (partition by facility_id) as first_reporting_month,
        count(*) over (partition by facility_id) as n_reports
      from fac) x where rn = 1"""

Q["battery_fact"] = """
select facility_id, reporting_month, row_id, oil_prod_m3, gas_prod_1000m3, gas_flared_1000m3, gas_vented_1000m3,
  water_prod_m3, total_wells, n_rows from bfact"""

Q["facility_pixel_agg"] = f"""
, pcm as (select round(latitude, 1) as lat_center, round(longitude, 1) as lon_center,
            cast(date_trunc('month', measurement_timestamp) as date) as month, count(*) as n_pixels, sum(ch4_column) as s
          from bronze_pix group by 1, 2, 3),
cen as (select distinct lat_center, lon_center from pcm),
fp as (select distinct facility_id, latitude, longitude from fac),
pairs as (select c.lat_center, c.lon_center, f.facility_id,
            {hav('c.lat_center', 'c.lon_center', 'f.latitude', 'f.longitude')} as d
          from cen c join fp f on {hav('c.lat_center', 'c.lon_center', 'f.latitude', 'f.longitude')} <= 10000.0e0),
pc as (select lat_center, lon_center, count(distinct facility_id) as n_facilities, min(d) as near from pairs group by 1, 2)
select pcm.lat_center, pcm.lon_center, month, n_pixels, s / n_pixels as mean_ch4, n_facilities,
  round(near / 1000.0e0, 3) as nearest_km
from pcm join pc on pcm.lat_center = pc.lat_center and pcm.lon_center = pc.lon_center"""

Q["ch4_hotspots"] = """
, g as (select * from bronze_pix where qa_value >= 0.7e0),
cells as (select round(latitude, 1) as lat_grid, round(longitude, 1) as lon_grid, count(*) as n_pixels,
            avg(ch4_column) as avg_ch4 from g group by 1, 2 having count(*) >= 5)
select lat_grid, lon_grid, n_pixels, avg_ch4, round(avg_ch4 - (select avg(ch4_column) from g), 4) as enhancement,
  rank() over (order by avg_ch4 desc) as hotspot_rank
from cells"""

_ENHANCEMENT = f"""
, pc as (select round(latitude, 1) as lat_center, round(longitude, 1) as lon_center,
           cast(date_trunc('month', measurement_timestamp) as date) as month, count(*) as n, sum(ch4_column) as s
         from bronze_pix group by 1, 2, 3),
regional as (select month, sum(s) / sum(n) as regional_mean from pc group by 1),
cen as (select distinct lat_center, lon_center from pc),
fp as (select distinct facility_id, latitude, longitude from fac),
pairs as (select distinct f.facility_id, c.lat_center, c.lon_center
          from fp f join cen c on {hav('f.latitude', 'f.longitude', 'c.lat_center', 'c.lon_center')} <= 10000.0e0),
near as (select facility_id, month, count(*) as n_centres, cast(sum(n) as bigint) as n_pixels_near, sum(s) as s
         from pairs join pc using (lat_center, lon_center) group by 1, 2),
eva as (
select near.facility_id, near.month, n_centres, n_pixels_near, round(s / n_pixels_near, 3) as mean_ch4_near,
  round(s / n_pixels_near - regional_mean, 3) as enhancement,
  gas_flared_1000m3 + gas_vented_1000m3 as emitted_1000m3, gas_prod_1000m3 as produced_1000m3,
  round((gas_flared_1000m3 + gas_vented_1000m3) / nullif(gas_prod_1000m3, 0), 6) as emission_ratio
from near join bfact on near.facility_id = bfact.facility_id and near.month = bfact.reporting_month
join regional on near.month = regional.month)
"""

Q["hotspots_from_day_states"] = Q["ch4_hotspots"]

Q["enhancement_vs_activity"] = _ENHANCEMENT + "select * from eva"

Q["activity_correlation"] = _ENHANCEMENT + """
select month, count(*) filter (where enhancement is not null and emitted_1000m3 is not null) as n_facilities,
  round(corr(enhancement, emitted_1000m3), 6) as correlation
from eva group by month"""


def oracle_sql() -> dict[str, str]:
    """Full statements: the shared CTEs, then each body (a body starting with ',' adds CTEs)."""
    out = {}
    for name, body in Q.items():
        b = body.strip()
        out[name] = BASE + b if b.startswith(",") else BASE + "\n" + b
    return out
