"""End-to-end batch loads: monthly battery CSVs -> bronze facilities, granules -> bronze pixels."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumeline.functions.location import with_location
from plumeline.model import (PROCESSING_LEVEL, PRODUCT_VERSION, TABLE_FACILITIES, TABLE_PIXELS)
from plumeline.functions.names import month_from_name
from plumeline.operators.medallion import PIXEL_KEY
from plumeline.operators.quality import facility_gates, pixel_gates
from plumeline.operators.sequence import id_block, sequence_ids
from plumeline.sources.battery_csv import battery_files, paths_of, read_battery_files
from plumeline.sources.ledger import REJECT_SCHEMA, REJECTS, staged_load
from plumeline.sources.swath import content_hashes, file_faults, flatten_swath, granule_files, read_granules
from plumeline.sources.tables import empty_like, rows_by_month


def battery_rows(spark: SparkSession, paths, mode: str = "as_written", bad_files: str = "raise") -> tuple[DataFrame, DataFrame]:
    """Located, numbered battery rows ready for bronze, and rejected rows with a reason.

    Per-file ``row_id`` runs 1..n in file line order after unlocated rows are dropped (W2); a file is its full
    path. ``bad_files``: "raise" for a file without the required columns or month, or "reject" to
    report it as one reject row.
    """
    raw, files, unclosed = read_battery_files(spark, paths, bad_files)
    geo = with_location(raw, "bty_location_raw", mode)
    located = geo.where(F.col("latitude").isNotNull() & ~F.col("_fractional_total_wells"))
    rejects = geo.where(F.col("latitude").isNull() | F.col("_fractional_total_wells")).select(
        F.col("_path").alias("source_path"), "source_file", "facility_id", "bty_location_raw",
        F.when(F.col("latitude").isNull(), F.lit("location_not_resolved"))
         .otherwise(F.lit("fractional_total_wells")).alias("reason"))
    none = F.lit(None).cast("string")
    rejects = rejects.unionByName(files.where(F.col("reason").isNotNull()).select(
        F.col("path").alias("source_path"), "source_file", none.alias("facility_id"), none.alias("bty_location_raw"), "reason"))
    rejects = rejects.unionByName(unclosed.select(F.col("path").alias("source_path"), "source_file", none.alias("facility_id"),
                                                  F.col("value").alias("bty_location_raw"), F.lit("unclosed_quote").alias("reason")))
    numbered = sequence_ids(located, ["_line_block", id_block("_line_pos"), "_line_pos"], group_cols=["_path"], out="row_id")
    return numbered.withColumnRenamed("_path", "source_path").drop("_line_block", "_line_pos", "_fractional_total_wells"), rejects


def battery_contents(spark: SparkSession, paths) -> DataFrame:
    """(path, size, content_hash) of the CSV files under ``paths``; the hash is a checksum of the lines, taken per split
    and summed, so no file is read in one task."""
    own = F.xxhash64("value")
    hashed = spark.read.text(paths_of(paths)).groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.concat_ws("-", F.count(F.lit(1)), F.hex(F.bit_xor(own)), F.hex(F.sum(F.shiftright(own, 20)))).alias("content_hash"))
    listed = spark.read.format("binaryFile").load(paths_of(paths)).select("path", F.col("length").alias("size"))
    return listed.join(hashed, "path", "left")


def load_battery_files(spark: SparkSession, paths, table: str = TABLE_FACILITIES, mode: str = "as_written",
                       skip_loaded_files: bool = False, bad_files: str = "raise", rejects_path: str | None = None,
                       gate: bool = False) -> dict:
    """Load located rows through the ledger; report rows loaded, rows rejected by reason and, per reporting month named by
    the files, the table's rows for that month afterwards (one partition-pruned count).

    Like the original loader, a re-run loads the same file again. ``skip_loaded_files`` leaves out files that are
    committed with the same path and content, and names them under ``files_skipped``; a file of the same name in another
    folder, or one whose content changed, is another file. A load that died is taken back first, so a retry gives every
    row once. Rejected rows are kept in the reject table and, with ``rejects_path``, written there as Parquet under the
    load's number. ``gate``: the batch must pass the facility gates before bronze sees it.
    """
    def rows_of(files: DataFrame) -> tuple[DataFrame, DataFrame]:
        chosen = [r["path"] for r in files.select("path").collect()]                    # files of this load
        rows, rejects = battery_rows(spark, chosen, mode, bad_files)
        return rows, rejects.withColumn("record", F.concat_ws(" ", "facility_id", "bty_location_raw"))

    res = staged_load(spark, table, battery_contents(spark, paths), rows_of, skip_loaded=skip_loaded_files,
                      gates=facility_gates if gate else None)
    if rejects_path and res["load_no"] is not None:
        refused = spark.table(REJECTS).where(F.col("load_no") == res["load_no"]).drop("load_no")
        refused.withColumn("rejected_at", F.current_timestamp()).write.mode("overwrite").parquet(f"{rejects_path.rstrip('/')}/load_no={res['load_no']}")
    months = battery_files(spark, paths).select(month_from_name("source_file").alias("m")).where("m is not null").distinct()
    res["rows_for_month"] = rows_by_month(spark, table, sorted(r["m"] for r in months.collect()))
    return res


def bronze_pixel_columns(granules: DataFrame, keep: tuple = ()) -> DataFrame:
    """Bronze pixel columns of granules: flattened, filtered and tagged, not yet numbered."""
    return flatten_swath(granules, keep=keep).select(
        F.col("time").alias("measurement_timestamp"), F.col("ch4").alias("ch4_column"),
        F.lit(None).cast("double").alias("ch4_column_precision"), F.col("qa").alias("qa_value"),
        F.col("lat").alias("latitude"), F.col("lon").alias("longitude"),
        F.col("orbit").alias("orbit_number"), F.lit(PROCESSING_LEVEL).alias("processing_level"),
        F.lit(PRODUCT_VERSION).alias("product_version"), F.col("source_file").alias("file_path"),
        "scanline", "ground_pixel", F.current_timestamp().alias("ingestion_timestamp"),
        F.to_date(F.col("time")).alias("measurement_date"), *keep)


def once_per_pixel(pixels: DataFrame) -> DataFrame:
    """One row per pixel (file, scanline, ground pixel) of a batch; of copies that differ the one measured last, then
    with the largest CH4 and QA. Copies are brought down before the shuffle."""
    rest = [c for c in pixels.columns if c not in PIXEL_KEY]
    best = F.max_by(F.struct(*rest), F.struct("measurement_timestamp", "ch4_column", "qa_value")).alias("_r")
    return pixels.groupBy(*PIXEL_KEY).agg(best).select(*PIXEL_KEY, "_r.*").select(*pixels.columns)


def number_pixels(pixels: DataFrame, existing_rows: int = 0) -> DataFrame:
    """Pixel rows numbered after ``existing_rows`` in (file, scanline, ground_pixel) order."""
    return sequence_ids(pixels, ["file_path", "scanline", "ground_pixel"], start=existing_rows, out="row_id")


def pixel_rows(granules: DataFrame, existing_rows: int = 0) -> DataFrame:
    """Bronze pixel rows from granules: flatten, filter, tag, and number after ``existing_rows``
    in (file, scanline, ground_pixel) order (W1)."""
    return number_pixels(bronze_pixel_columns(granules), existing_rows)


def no_rejects(spark: SparkSession) -> DataFrame:
    return empty_like(spark, REJECT_SCHEMA)


def load_pixel_batch(spark: SparkSession, pixels: DataFrame, batch: str, table: str = TABLE_PIXELS, gate: bool = False) -> dict:
    """Load pixel columns that are at hand as a DataFrame as one batch of the ledger, named ``batch``."""
    files = spark.createDataFrame([(batch, None, None)], "path string, size long, content_hash string")
    rows = once_per_pixel(pixels.withColumn("source_path", F.lit(batch)))
    return staged_load(spark, table, files, lambda _: (rows, no_rejects(spark)), number=number_pixels, skip_loaded=False,
                       gates=pixel_gates if gate else None)


def load_granules(spark: SparkSession, granules, table: str = TABLE_PIXELS, skip_loaded_files: bool = False, gate: bool = False) -> dict:
    """Load granules, given as paths or as a DataFrame, into the bronze pixel table through the ledger.

    Ids go on after the highest id ever given out for the table. A pixel delivered several times in one load lands
    once. With paths, each file stands for itself: one that is empty, cut off, unreadable, without rows or without swath
    data is left out and becomes a reject with its reason (under ``rejects`` and in the reject table), all others load.
    ``gate``: the batch must pass the pixel gates before bronze sees it.
    """
    if isinstance(granules, DataFrame):
        return load_pixel_batch(spark, bronze_pixel_columns(granules), f"rows:{uuid4()}", table, gate)

    def rows_of(files: DataFrame) -> tuple[DataFrame, DataFrame]:
        chosen = [r["path"] for r in files.select("path").collect()]                    # files of this load
        found = read_granules(spark, chosen)
        faults = file_faults(spark, chosen, found)
        landed = found.withColumn("source_path", F.col("_metadata.file_path"))
        rejects = faults.select(F.col("path").alias("source_path"), F.element_at(F.split("path", "/"), -1).alias("source_file"), "reason")
        return once_per_pixel(bronze_pixel_columns(landed, keep=("source_path",))), rejects

    files = granule_files(spark, granules).join(content_hashes(read_granules(spark, granules)), "path", "left")
    res = staged_load(spark, table, files, rows_of, number=number_pixels, skip_loaded=skip_loaded_files,
                      gates=pixel_gates if gate else None)
    refused = spark.table(REJECTS).where(F.col("load_no") == F.lit(res["load_no"]).cast("long"))
    res["rejects"] = {r["source_path"]: r["reason"] for r in refused.orderBy("source_path").limit(1000).collect()}
    return res
