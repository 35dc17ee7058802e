"""Incremental landing-folder ingest: new files load once, re-runs load nothing."""

import os
import shutil

from plumeline.model import TABLE_FACILITIES, TABLE_PIXELS
from plumeline.plans import fixtures as fx
from plumeline.sources import tables
from plumeline.streaming.incremental import ingest_battery_landing, ingest_granule_landing
from tests.test_sources import _write


def test_battery_landing_loads_each_file_once(spark, scratch):
    tables.create_bronze_tables(spark)
    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    ckpt = os.path.join(scratch, "ckpt")
    _write(landing, "ST60_2024_06.csv", ["ABBT0000001,F1,OP A,T1,d,02-21-065-04W4,1,10,1,1,1,1",
                                         "ABBT0000002,F2,OP B,T1,d,0465040102,1,20,1,1,1,1"])
    first = ingest_battery_landing(spark, landing, ckpt)
    assert sum(r["rows_loaded"] for r in first) == 2
    assert ingest_battery_landing(spark, landing, ckpt) == []          # nothing new
    _write(landing, "ST60_2024_07.csv", ["ABBT0000001,F1,OP A,T1,d,02-21-065-04W4,1,30,1,1,1,1"])
    third = ingest_battery_landing(spark, landing, ckpt)
    assert sum(r["rows_loaded"] for r in third) == 1
    assert spark.table(TABLE_FACILITIES).count() == 3


def test_granule_landing_appends_with_continuing_ids(spark, scratch):
    tables.create_bronze_tables(spark)
    gran = fx.granules(spark, "/root/testdata/sf0.001")
    landing = os.path.join(scratch, "granules")
    gran.where("orbit_attr < 36008").write.parquet(os.path.join(landing, "a"))
    staged = os.path.join(scratch, "staged")
    gran.where("orbit_attr >= 36008 or orbit_attr is null").write.parquet(staged)
    ckpt = os.path.join(scratch, "gckpt")
    src = os.path.join(landing, "*")
    r1 = ingest_granule_landing(spark, src, ckpt, gran.schema)
    shutil.copytree(staged, os.path.join(landing, "b"))
    r2 = ingest_granule_landing(spark, src, ckpt, gran.schema)
    n = sum(r["rows_loaded"] for r in r1 + r2)
    assert n == fx.bronze_pixels(fx.pixels(spark, "/root/testdata/sf0.001")).count()
    ids = sorted(r.row_id for r in spark.table(TABLE_PIXELS).select("row_id").collect())
    assert ids == list(range(1, n + 1))


def test_granule_append_is_idempotent_per_file(spark):
    from plumeline.streaming.incremental import append_new_granules
    tables.create_bronze_tables(spark)
    gran = fx.granules(spark, "/root/testdata/sf0.001")
    first = append_new_granules(spark, gran)
    again = append_new_granules(spark, gran)
    assert first["rows_loaded"] > 0 and again["rows_loaded"] == 0
    assert spark.table(TABLE_PIXELS).count() == first["rows_loaded"]
