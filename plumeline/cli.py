"""Command-line jobs: the same workflow as the original scripts, run on Spark.

  python -m plumeline.cli create-tables
  python -m plumeline.cli load-batteries data/raw/ST60_2025-01.csv ...
  python -m plumeline.cli load-granules data/raw/sentinel5p/          (granule-block Parquet)
  python -m plumeline.cli validate-pixels | validate-facilities
  python -m plumeline.cli retain [--days N]                          (drop what is out of the window)
  python -m plumeline.cli build-silver | build-gold | refresh        (refresh: only the days of new loads)
  python -m plumeline.cli export-aggregates OUT_DIR                  (the plotted aggregates, as Parquet)
  python -m plumeline.cli ingest-landing LANDING_DIR CHECKPOINT_DIR  (only files not loaded before)
  python -m plumeline.cli ingest-granule-landing LANDING_DIR CHECKPOINT_DIR

Audits print (check, value, status) rows and exit 1 when a check FAILED.
"""

from __future__ import annotations

import argparse
import json
import sys

from plumeline.model import RETENTION_DAYS, TABLE_FACILITIES, TABLE_PIXELS


def _session(args):
    from plumeline.session import build_session
    return build_session(args.master)


def cmd_create_tables(spark, args):
    from plumeline.sources.tables import create_bronze_tables, list_tables
    made = create_bronze_tables(spark, replace=not args.keep)
    return {"created": made, "bronze_tables": list_tables(spark, "bronze")}


def cmd_load_batteries(spark, args):
    from plumeline.sources.ingest import load_battery_files
    return load_battery_files(spark, args.paths, mode=args.mode,
                              skip_loaded_files=getattr(args, "skip_loaded", False), gate=getattr(args, "gate", False))


def cmd_load_granules(spark, args):
    from plumeline.sources.ingest import load_granules
    return load_granules(spark, args.paths, skip_loaded_files=getattr(args, "skip_loaded", False), gate=getattr(args, "gate", False))


def _audit(df):
    rows = df.collect()
    for r in rows:
        print(f"{r.check:24s} {r.value!s:>14s}  {r.status}")
    return {"failed": [r.check for r in rows if r.status == "FAILED"]}


def cmd_validate_pixels(spark, args):
    from plumeline.operators.quality import audit_pixels
    return _audit(audit_pixels(spark.table(TABLE_PIXELS), spark.table(TABLE_FACILITIES)))


def cmd_validate_facilities(spark, args):
    from plumeline.operators import aggregates as A
    from plumeline.operators.quality import audit_facilities
    fac = spark.table(TABLE_FACILITIES)
    for title, df in [("top operators", A.top_operators(fac)), ("extent", A.facility_extent(fac)),
                      ("monthly production", A.monthly_production(fac))]:
        print(f"-- {title}")
        print("\t".join(df.columns))
        for r in df.toLocalIterator():                            # every row, e.g. every month
            print("\t".join(str(v) for v in r))
    return _audit(audit_facilities(fac))


def cmd_retain(spark, args):
    from plumeline.sources.retention import apply_retention
    return {"tables": apply_retention(spark, args.days)}


def cmd_build_silver(spark, args):
    from plumeline.operators.medallion import write_facility_tables, write_silver
    return {**write_silver(spark), "facility_tables": write_facility_tables(spark)}


def cmd_build_gold(spark, args):
    from plumeline.operators.medallion import write_hotspots
    return write_hotspots(spark)


def cmd_refresh(spark, args):
    from plumeline.sources.refresh import refresh_hotspots, refresh_silver
    return {"tables": [refresh_silver(spark), refresh_hotspots(spark)]}


def cmd_export_aggregates(spark, args):
    from plumeline.operators import aggregates as A
    from plumeline.sources.tables import write_parquet
    pix, fac = spark.table(TABLE_PIXELS), spark.table(TABLE_FACILITIES)
    outputs = {"grid_mean_005": A.grid_mean_snap(pix), "grid_mean_01": A.grid_mean_round(pix),
               "qa_histogram": A.qa_histogram(pix), "ch4_histogram": A.ch4_histogram(pix),
               "facility_preview": A.facility_preview(fac)}
    for name, df in outputs.items():
        write_parquet(df, f"{args.out.rstrip('/')}/{name}")         # AQE merges small partitions
    return {"written": sorted(outputs)}


def cmd_ingest_landing(spark, args):
    from plumeline.streaming.incremental import ingest_battery_landing
    return {"batches": ingest_battery_landing(spark, args.landing, args.checkpoint, mode=args.mode)}


def cmd_ingest_granule_landing(spark, args):
    from plumeline.model import GRANULE_SCHEMA
    from plumeline.streaming.incremental import ingest_granule_landing
    return {"batches": ingest_granule_landing(spark, args.landing, args.checkpoint, GRANULE_SCHEMA)}


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="plumeline")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("create-tables"); s.add_argument("--keep", action="store_true")
    s = sub.add_parser("load-batteries"); s.add_argument("paths", nargs="+"); s.add_argument("--mode", default="as_written")
    s.add_argument("--skip-loaded", action="store_true", help="skip files already in the table")
    s.add_argument("--gate", action="store_true", help="audit the staged batch first; a bad batch never shows up in bronze")
    s = sub.add_parser("load-granules"); s.add_argument("paths", nargs="+")
    s.add_argument("--skip-loaded", action="store_true", help="skip files loaded with the same content")
    s.add_argument("--gate", action="store_true", help="audit the staged batch first; a bad batch never shows up in bronze")
    sub.add_parser("validate-pixels")
    sub.add_parser("validate-facilities")
    s = sub.add_parser("retain"); s.add_argument("--days", type=int, default=RETENTION_DAYS)
    sub.add_parser("build-silver")
    sub.add_parser("build-gold")
    sub.add_parser("refresh")
    s = sub.add_parser("export-aggregates"); s.add_argument("out")
    s = sub.add_parser("ingest-landing"); s.add_argument("landing"); s.add_argument("checkpoint")
    s.add_argument("--mode", default="as_written")
    s = sub.add_parser("ingest-granule-landing"); s.add_argument("landing"); s.add_argument("checkpoint")
    args = p.parse_args(argv)
    spark = _session(args)
    result = globals()["cmd_" + args.cmd.replace("-", "_")](spark, args)
    print(json.dumps(result, default=str))
    return 1 if isinstance(result, dict) and result.get("failed") else 0


if __name__ == "__main__":
    sys.exit(main())
