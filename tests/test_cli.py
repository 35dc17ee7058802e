"""The command-line workflow end to end in a scratch warehouse."""

import os

from plumeline import cli
from plumeline.plans import fixtures as fx
from tests.test_sources import _write


def test_cli_workflow(spark, scratch, capsys):
    class A:  # argparse-like namespace
        pass

    def args(**kw):
        a = A()
        a.__dict__.update(kw)
        return a

    assert "bronze.aer_battery_monthly" in cli.cmd_create_tables(spark, args(keep=False))["created"]
    p = _write(scratch, "ST60_2024_07.csv", ["ABBT0000001,F1,OP A,T1,d,02-21-065-04W4,1,10,1,1,1,1",
                                              "ABBT0000002,F2,OP B,T1,d,0465040102,1,20,1,1,1,1"])
    assert cli.cmd_load_batteries(spark, args(paths=[p], mode="as_written"))["rows_loaded"] == 2
    gdir = os.path.join(scratch, "granules")
    fx.granules(spark, "/root/testdata/sf0.001").write.parquet(gdir)
    loaded = cli.cmd_load_granules(spark, args(paths=[gdir]))["rows_loaded"]
    assert loaded == fx.bronze_pixels(fx.pixels(spark, "/root/testdata/sf0.001")).count()
    res = cli.cmd_validate_pixels(spark, args())
    assert res["failed"] == []
    cli.cmd_validate_facilities(spark, args())
    assert cli.cmd_build_silver(spark, args())["rows"] > 0
    assert cli.cmd_build_gold(spark, args())["rows"] >= 0
    out = os.path.join(scratch, "aggregates")
    cli.cmd_export_aggregates(spark, args(out=out))
    assert sorted(os.listdir(out)) == ["ch4_histogram", "facility_preview", "grid_mean_005", "grid_mean_01",
                                       "qa_histogram"]
    printed = capsys.readouterr().out
    assert "row_count" in printed and "monthly production" in printed


def test_cli_granule_landing(spark, scratch):
    from plumeline.model import GRANULE_SCHEMA, TABLE_PIXELS
    from plumeline.sources.tables import create_bronze_tables
    create_bronze_tables(spark)
    gran = fx.granules(spark, "/root/testdata/sf0.001")
    assert gran.schema == GRANULE_SCHEMA
    landing = os.path.join(scratch, "landing")
    gran.write.parquet(os.path.join(landing, "day1"))

    class A:
        landing = os.path.join(scratch, "landing", "*")
        checkpoint = os.path.join(scratch, "ckpt")

    res = cli.cmd_ingest_granule_landing(spark, A())
    assert sum(b["rows_loaded"] for b in res["batches"]) == spark.table(TABLE_PIXELS).count() > 0
