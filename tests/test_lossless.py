"""Nothing is lost without a word: split granules, odd CSV layouts, NULL groups, whole-globe distances."""

import os
import random

import pytest
from pyspark.sql import functions as F

from plumeline.functions.location import WHITE_SPACE, with_location
from plumeline.model import GRANULE_SCHEMA, TABLE_FACILITIES, TABLE_PIXELS
from plumeline.operators.sequence import id_block, sequence_ids
from plumeline.operators.spatial import distance_inner_join, distance_semi_join, within_radius
from plumeline.plans import fixtures as fx
from plumeline.sources import battery_csv, ingest, swath, tables
from plumeline.sources.battery_csv import CsvLayoutError
from plumeline.streaming.incremental import append_new_granules, ingest_battery_landing, ingest_granule_landing
from tests.test_sources import _write
from tests.test_spatial import hav

SF = "/root/testdata/sf0.001"
LICENCE_FIRST = "LICENCE,BATTERY,BTY LOCATION EDIT,OPERATOR,BTY,BTY,GAS PROD,OIL PROD,GAS FLARED,GAS VENTED,WTR PROD,TOTAL,EXTRA"


def test_blocks_of_one_file_arriving_in_several_batches_all_land_once(spark, scratch):
    tables.create_bronze_tables(spark)
    gran = fx.granules(spark, SF).cache()
    want = swath.flatten_swath(gran).count()
    landing = os.path.join(scratch, "landing")
    # Every landing file holds blocks of every swath file.
    for i in range(3):
        part = gran.where(F.pmod(F.col("first_scanline") / 64 + F.coalesce("orbit_attr", F.lit(0)), F.lit(3)) == i)
        part.coalesce(1).write.parquet(os.path.join(landing, str(i)))
    got = ingest_granule_landing(spark, os.path.join(landing, "*"), os.path.join(scratch, "ckpt"), GRANULE_SCHEMA, max_files_per_trigger=1)
    assert len(got) == 3 and sum(r["rows_loaded"] for r in got) == want
    key = ["file_path", "scanline", "ground_pixel"]
    table = spark.table(TABLE_PIXELS)
    assert table.count() == table.select(*key).distinct().count() == want
    assert sorted(r.row_id for r in table.select("row_id").collect()) == list(range(1, want + 1))
    assert append_new_granules(spark, gran)["rows_loaded"] == 0          # a retried batch adds nothing
    gran.unpersist()


def test_pixels_without_an_orbit_are_kept_and_unreadable_files_are_named(spark, scratch):
    gran = fx.granules(spark, SF)
    assert swath.flatten_swath(gran).where("orbit is null").count() > 0
    folder = os.path.join(scratch, "granules")
    gran.repartition(2).write.parquet(folder)
    parts = sorted(p for p in os.listdir(folder) if p.endswith(".parquet"))
    with open(os.path.join(folder, parts[0]), "rb") as src, open(os.path.join(folder, "truncated.parquet"), "wb") as out:
        out.write(src.read()[:200])
    read = swath.read_granules(spark.newSession(), folder).select("*")
    assert read.count() == gran.count()
    bad = swath.file_faults(spark, folder).collect()
    assert [(os.path.basename(r["path"]), r["reason"]) for r in bad] == [("truncated.parquet", "not_parquet")]


def test_columns_are_found_by_name_in_each_file(spark, scratch):
    a = _write(scratch, "ST60_2024_06.csv", ["F1,ABBT1,02-21-065-04W4,OP A,T1,first,20,1.5,1,0.5,3,4,x"], header=LICENCE_FIRST)
    b = _write(scratch, "ST60_2024_07.csv", ["ABBT2,F2,OP B,T2,second,0465040102,2,10,1,0.5,3,5"])
    rows = {r.facility_id: r for r in battery_csv.read_battery_csv(spark, [a, b]).collect()}
    assert (rows["ABBT1"].licence, rows["ABBT1"].gas_prod_1000m3, rows["ABBT1"].facility_description) == ("F1", 20.0, "first")
    assert (rows["ABBT2"].licence, rows["ABBT2"].oil_prod_m3, rows["ABBT2"].total_wells) == ("F2", 2.0, 5)


def test_bad_files_raise_or_become_rejects(spark, scratch):
    good = _write(scratch, "ST60_2024_06.csv", ["ABBT1,F1,OP A,T1,d,02-21-065-04W4,1,20,1,1,1,1"])
    other = _write(scratch, "ST60_2024_07.csv", ["x,y"], header="Battery,Licence")
    nomonth = _write(scratch, "nomonth.csv", ["ABBT9,F1,OP A,T1,d,02-21-065-04W4,1,20,1,1,1,1"])
    with pytest.raises(CsvLayoutError):
        battery_csv.read_battery_csv(spark, [good, other])
    with pytest.raises(ValueError):
        battery_csv.read_battery_csv(spark, os.path.join(scratch, "*.csv").replace("*.csv", "[n]*.csv"))
    rows, rejects = ingest.battery_rows(spark, [good, other, nomonth], bad_files="reject")
    assert [r.facility_id for r in rows.collect()] == ["ABBT1"]
    assert {(os.path.basename(r.source_path), r.reason) for r in rejects.collect()} == {
        ("ST60_2024_07.csv", "no_required_column"), ("nomonth.csv", "no_month_in_name")}


def test_files_with_one_base_name_are_two_files(spark, scratch):
    for folder in ("x", "y"):
        os.makedirs(os.path.join(scratch, folder))
    a = _write(os.path.join(scratch, "x"), "ST60_2024-02.csv", ["ABBT1,F1,OP A,T1,d,02-21-065-04W4,1,20,1,1,1,1"])
    b = _write(os.path.join(scratch, "y"), "ST60_2024-02.csv", ["ABBT2,F1,OP A,T1,d,02-21-065-04W4,1,20,1,1,1,1"] * 2)
    rows, _ = ingest.battery_rows(spark, [a, b])
    assert sorted((r.facility_id, r.row_id) for r in rows.collect()) == [("ABBT1", 1), ("ABBT2", 1), ("ABBT2", 2)]


def test_landing_counts_and_stores_rejects(spark, scratch):
    tables.create_bronze_tables(spark)
    landing, rejects = os.path.join(scratch, "landing"), os.path.join(scratch, "rejects")
    os.makedirs(landing)
    _write(landing, "ST60_2024_06.csv", ["ABBT1,F1,OP A,T1,d,02-21-065-04W4,1,20,1,1,1,1", "ABBT2,F,O,T,d,junk,1,1,1,1,1,1"])
    _write(landing, "ST60_2024_07.csv", ["x,y"], header="Battery,Licence")
    res = ingest_battery_landing(spark, landing, os.path.join(scratch, "ckpt"), rejects_path=rejects)
    assert sum(r["rows_loaded"] for r in res) == 1 == spark.table(TABLE_FACILITIES).count()
    assert res[0]["rows_rejected"] == {"location_not_resolved": 1, "no_required_column": 1}
    assert spark.read.parquet(rejects).count() == 2


def test_null_groups_and_keys_are_numbered(spark):
    rows = [(None if i % 3 == 0 else f"g{i % 2}", None if i % 5 == 0 else i // 10, i) for i in range(300)]
    out = sequence_ids(spark.createDataFrame(rows, "g string, k int, i int"), ["k", id_block("i", 7), "i"], group_cols=["g"], out="n").collect()
    assert len(out) == len(rows)
    for g in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        assert sorted((r.n, r.i) for r in out if r.g == g) == [(k + 1, r[2]) for k, r in enumerate(own)]


def test_all_white_space_is_stripped_and_geocoding_does_not_shuffle(spark):
    texts = [c + "02-21-065-04W4" + c for c in WHITE_SPACE] + ["02-21-065-04W4"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, loc string")
    out = with_location(df, "loc", located_only=True)
    assert out.count() == len(texts) and out.select("latitude", "longitude").distinct().count() == 1
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("radius", [2_000.0, 300_000.0, 4_000_000.0, 12_000_000.0])
def test_distance_joins_over_the_whole_globe(spark, radius):
    rng = random.Random(int(radius))

    def point():
        lat = rng.choice([rng.uniform(-90, 90), rng.uniform(88, 90), rng.uniform(-90, -89), rng.uniform(-1, 1)])
        lon = rng.choice([rng.uniform(-180, 180), rng.uniform(179.9, 180), rng.uniform(-180, -179.9)])
        return lat, lon
    left = [(i, *point()) for i in range(60)]
    right = [(i, *point()) for i in range(30)]
    right += [(100 + i, min(a + 0.005, 90.0), -b if abs(b) > 179.99 else b) for i, a, b in left[:20]]
    ldf, rdf = (spark.createDataFrame(x, "id int, latitude double, longitude double") for x in (left, right))
    want = {(i, j) for i, a, b in left for j, c, d in right if hav(a, b, c, d) <= radius}
    got = [(r.id, r.r_id) for r in distance_inner_join(ldf, rdf, radius).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert {r.id for r in distance_semi_join(ldf, rdf, radius).collect()} == {i for i, _ in want}
    for _, a, b in right[:4]:
        near = {r.id for r in within_radius(ldf, a, b, radius).collect()}
        assert near == {i for i, c, d in left if hav(a, b, c, d) <= radius}


def test_pairs_across_the_antimeridian(spark):
    df = spark.createDataFrame([(1, 10.0, 179.99)], "id int, latitude double, longitude double")
    other = spark.createDataFrame([(2, 10.0, -179.99)], "id int, latitude double, longitude double")
    assert distance_inner_join(df, other, 10_000.0).count() == 1


def test_retention_prunes_partitions(spark, scratch):
    from plumeline.operators.medallion import silver_pixels
    tables.create_bronze_tables(spark)
    ingest.load_granules(spark, fx.granules(spark, SF))
    silver = silver_pixels(spark.table(TABLE_PIXELS))
    plan = silver._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(measurement_date" in plan
    rows = spark.table(TABLE_PIXELS).select("measurement_date").distinct().count()
    assert silver.count() > 0 and silver.select(F.to_date("measurement_timestamp")).distinct().count() < rows
