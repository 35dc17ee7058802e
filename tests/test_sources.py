"""Readers and writers on files in a fresh scratch folder."""

import os

import pytest
from pyspark.sql import functions as F

from plumeline.model import TABLE_FACILITIES, TABLE_PIXELS
from plumeline.plans import fixtures as fx
from plumeline.sources import battery_csv, ingest, swath, tables
from plumeline.sources.battery_csv import CsvLayoutError

HEADER = "BATTERY,LICENCE,OPERATOR,BTY,BTY,BTY LOCATION EDIT,OIL PROD,GAS PROD,GAS FLARED,GAS VENTED,WTR PROD,TOTAL"
UNITS = ",,,,,,m3,1000m3,1000m3,1000m3,m3,"


def _write(folder, name, rows, header=HEADER):
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        fh.write(f"Monthly battery report {name}\n{header}\n{UNITS}\n")
        for r in rows:
            fh.write(r + "\n")
    return path


def test_csv_preamble_names_and_coercion(spark, scratch):
    p1 = _write(scratch, "ST60_2024_06.csv", [
        "ABBT0000001,F1,OP A,T1,type 1,02-21-065-04W4,1.5,10,1,0.5,3,4",
        "ABBT0000002,F2,OP B,T2,type 2,junk,1,2,3,4,5,6",
        "ABBT0000003,F3,,T3,type 3,0465040102,n/a,12d,1e3, 12 ,1,2.5",
        "ABBT0000004,F4,OP A,T4,type 4,0465040102,1,\"1,234\",,inf,1,7",
    ])
    p2 = _write(scratch, "ST60_2024-07.csv", ["ABBT0000001,F1,OP A,T1,type 1,02-21-065-04W4,2,20,2,1,6,4"])
    raw = battery_csv.read_battery_csv(spark, [p1, p2]).orderBy("reporting_month", "_line_block", "_line_pos").collect()
    assert [r.facility_id for r in raw] == ["ABBT0000001", "ABBT0000002", "ABBT0000003", "ABBT0000004", "ABBT0000001"]
    assert [str(r.reporting_month) for r in raw] == ["2024-06-01"] * 4 + ["2024-07-01"]
    r3 = raw[2]
    assert r3.operator is None and r3.oil_prod_m3 is None and r3.gas_prod_1000m3 is None
    assert r3.gas_flared_1000m3 == 1000.0 and r3.gas_vented_1000m3 == 12.0
    assert r3.total_wells is None and r3._fractional_total_wells
    assert raw[3].gas_prod_1000m3 is None and raw[3].gas_vented_1000m3 == float("inf")
    assert raw[0].facility_type == "T1" and raw[0].facility_description == "type 1"

    rows, rejects = ingest.battery_rows(spark, [p1, p2])
    got = sorted((r.source_file, r.row_id, r.facility_id) for r in rows.collect())
    assert got == [("ST60_2024-07.csv", 1, "ABBT0000001"), ("ST60_2024_06.csv", 1, "ABBT0000001"),
                   ("ST60_2024_06.csv", 2, "ABBT0000004")]
    assert sorted((r.facility_id, r.reason) for r in rejects.collect()) == [
        ("ABBT0000002", "location_not_resolved"), ("ABBT0000003", "fractional_total_wells")]


def test_csv_rows_numbered_in_line_order_across_many_splits(spark, scratch):
    n = 400
    locs = ["02-21-065-04W4", "0465040102", "bad"]
    lines = [f"ABBT{i:07d},F{i},OP,T,d,{locs[i % 3]},1,{i},1,1,1,1" for i in range(n)]
    path = _write(scratch, "ST60_2024_01.csv", lines)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        rows, _ = ingest.battery_rows(spark, [path])
        got = sorted((r.row_id, r.facility_id) for r in rows.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    expected = [f"ABBT{i:07d}" for i in range(n) if i % 3 != 2]
    assert got == list(zip(range(1, len(expected) + 1), expected))


def test_csv_layout_and_name_errors(spark, scratch):
    bad = _write(scratch, "ST60_2024_06.csv", ["x"], header="BATTERY,LICENCE,OPERATOR")
    with pytest.raises(CsvLayoutError):
        battery_csv.read_battery_csv(spark, [bad])
    good = _write(scratch, "no_month.csv", ["ABBT1,F,OP,T,d,02-21-065-04W4,1,1,1,1,1,1"])
    with pytest.raises(ValueError):
        battery_csv.check_month_in_names([good])


def test_bronze_tables_create_append_count_list(spark, scratch):
    made = tables.create_bronze_tables(spark)
    assert set(made) == {TABLE_FACILITIES, TABLE_PIXELS}
    assert tables.list_tables(spark, "bronze") == ["aer_battery_monthly", "sentinel5p_raw"]
    p = _write(scratch, "ST60_2024_06.csv", ["ABBT0000001,F1,OP A,T1,type 1,02-21-065-04W4,1.5,10,1,0.5,3,4"])
    res = ingest.load_battery_files(spark, [p])
    assert res["rows_loaded"] == 1 and res["rows_for_month"] == {"2024-06-01": 1}
    again = ingest.load_battery_files(spark, [p], skip_loaded_files=True)
    assert again["rows_loaded"] == 0 and again["rows_for_month"] == {"2024-06-01": 1}
    row = spark.table(TABLE_FACILITIES).collect()[0]
    # Written by name: operator, licence and facility_type land in their own columns.
    assert (row.licence, row.operator, row.facility_type) == ("F1", "OP A", "T1")
    assert tables.rows_for_month(spark, TABLE_FACILITIES, "2024-06-01") == 1

    gran = fx.granules(spark, "/root/testdata/sf0.001")
    first = ingest.load_granules(spark, gran)
    second = ingest.load_granules(spark, gran)       # a reload appends again with fresh ids
    assert first["rows_loaded"] == second["rows_loaded"] > 0
    ids = [r.row_id for r in spark.table(TABLE_PIXELS).select("row_id").collect()]
    assert sorted(ids) == list(range(1, 2 * first["rows_loaded"] + 1))
    from plumeline.operators.aggregates import duplicate_audit
    audit = duplicate_audit(spark.table(TABLE_PIXELS)).collect()[0]
    assert audit.duplicate_row_ids == 0 and audit.duplicate_natural_keys == first["rows_loaded"]
    # Partitioned by measurement day: a date filter prunes folders.
    one_day = spark.table(TABLE_PIXELS).where(F.col("measurement_date") == "2024-01-05").select("row_id")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(measurement_date" in plan
    assert one_day.count() == spark.table(TABLE_PIXELS).where(
        F.to_date("measurement_timestamp") == "2024-01-05").count() > 0


def test_swath_round_trip_and_report(spark):
    d = "/root/testdata/sf0.001"
    gran = fx.granules(spark, d)
    flat = swath.flatten_swath(gran).select("scanline", "ground_pixel", "orbit", "ch4", "qa", "lat", "lon")
    direct = fx.bronze_pixels(fx.pixels(spark, d)).select(
        F.col("scanline").cast("long"), F.col("ground_pixel").cast("long"),
        F.when(F.col("orbit_number") % 8 != 3, F.col("orbit_number")).alias("orbit"),
        F.col("ch4_column").alias("ch4"), F.col("qa_value").alias("qa"), F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"))
    assert flat.exceptAll(direct).count() == 0 and direct.exceptAll(flat).count() == 0

    odd = spark.sql("""select cast(null as int) as orbit_attr, 'granule.nc' as file_path, 0L as first_scanline,
        array(array(named_struct('time', timestamp_ntz'2024-01-01 00:00:00', 'lat', 50.0D, 'lon', -115.0D,
                                 'ch4', 1800.0D, 'qa', 0.9D))) as swath""")
    report = {r.file_path: r.status for r in swath.granule_load_report(gran.unionByName(odd)).collect()}
    assert report["granule.nc"] == "loaded"                        # kept, with a note
    notes = {r.file_path for r in swath.granule_load_report(gran.unionByName(odd)).where("note = 'no_orbit'").collect()}
    assert notes == {"granule.nc", "no_orbit_anywhere.nc", "granule_36003.nc", "granule_36011.nc"}
    assert report["missing_variable.nc"] == "missing_variable"
    assert sum(1 for s in report.values() if s == "loaded") == 17
    rejects = {r.file_path for r in swath.rejected_granules(gran.unionByName(odd)).collect()}
    assert rejects == {"missing_variable.nc", "no_orbit_anywhere.nc"}


def test_parquet_writer_partitions_and_pushdown(spark, scratch):
    from plumeline.operators.filters import in_bbox
    pix = fx.bronze_pixels(fx.pixels(spark, "/root/testdata/sf0.001")).withColumn(
        "day", F.to_date("measurement_timestamp"))
    out = os.path.join(scratch, "pixels")
    tables.write_parquet(pix, out, partition_by=["day"])
    assert any(name.startswith("day=") for name in os.listdir(out))
    back = spark.read.parquet(out)
    plan = in_bbox(back.where(F.col("day") == "2024-01-02")).select("latitude")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PushedFilters: [IsNotNull(latitude), IsNotNull(longitude), GreaterThanOrEqual(latitude,49.0)" in plan
    assert "PartitionFilters: [isnotnull(day" in plan
