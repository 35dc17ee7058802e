"""Incremental refresh of the silver pixels and the hotspots (D1, D6): only days that new loads touch are written.

A mark per load says what a table has taken in already; the committed loads without a mark are new. The silver rows of
one swath file depend on that file's bronze rows alone (its name is part of the pixel key), so the files of the new loads are
computed again and, on the days they have pixels on, take the place of their former rows; rows of other files stay as
they are. Hotspots come from a table of cell states (count and sum per day and cell): the states of changed days are
replaced, and all states merge into the ranking, which reads one row per day and cell instead of the pixels.

A refresh that dies may be run again: it has no mark yet and writes the same days once more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumeline.model import TABLE_HOTSPOTS, TABLE_PIXELS, TABLE_PIXELS_SILVER
from plumeline.operators.medallion import cell_states, hotspots_of, silver_pixels
from plumeline.sources.ledger import create_ledger, drop_folders, dynamic_overwrite, load_states, partition_folders
from plumeline.sources.retention import newest_time, retain
from plumeline.sources.tables import clustered, conform, create_layers, materialized

MARKS = "ops.refresh_marks"
CELL_DAYS = "gold.cell_days"


def new_loads(spark: SparkSession, table: str) -> DataFrame:
    """(load_no) of the committed pixel loads that ``table`` has not taken in."""
    create_ledger(spark)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {MARKS} (table_name string, load_no bigint) USING parquet")
    done = spark.table(MARKS).where(F.col("table_name") == table).select("load_no")
    return materialized(load_states(spark, TABLE_PIXELS).where("status = 'committed'").select("load_no").distinct().join(done, "load_no", "left_anti"))


def _mark(spark: SparkSession, table: str, loads: DataFrame) -> None:
    loads.select(F.lit(table).alias("table_name"), "load_no").write.mode("append").insertInto(MARKS)
    spark.catalog.refreshTable(MARKS)


def _replace_days(spark: SparkSession, table: str, rows: DataFrame, days: list[str]) -> None:
    """Write ``rows`` over the folders of ``days``; a day without rows loses its folder."""
    rows = materialized(conform(rows, spark.table(table).schema))
    written = {str(r["day"]) for r in rows.select("day").distinct().collect()}
    if written:
        with dynamic_overwrite(spark):
            clustered(rows, ["day"]).write.insertInto(table, overwrite=True)
        spark.catalog.refreshTable(table)
    drop_folders(spark, table, [p for p in partition_folders(spark, table) if p["day"] in days and p["day"] not in written])


def _days(df: DataFrame) -> list[str]:
    """Days of a table's rows: at most a retention window of them."""
    return sorted(str(r["d"]) for r in df.select(F.col("measurement_date").alias("d")).distinct().collect())


def _create_like(df: DataFrame, table: str) -> None:
    if not df.sparkSession.catalog.tableExists(table):
        df.limit(0).write.format("parquet").option("compression", "zstd").partitionBy("day").saveAsTable(table)


def refresh_silver(spark: SparkSession, table: str = TABLE_PIXELS_SILVER) -> dict:
    """Take the new loads into the silver pixels; the result equals a full rebuild."""
    create_layers(spark)
    bronze, newest = spark.table(TABLE_PIXELS), newest_time(spark)
    shape = silver_pixels(bronze).withColumn("day", F.to_date("measurement_timestamp"))
    _create_like(shape, table)
    loads = new_loads(spark, table)
    files = materialized(bronze.join(loads, "load_no", "left_semi").select("file_path").distinct())
    same = lambda df: df["file_path"].eqNullSafe(files["file_path"])
    days: list[str] = []
    if newest is not None and not files.isEmpty():
        part = bronze.join(files, same(bronze), "left_semi")
        days = _days(part)
        fresh = silver_pixels(part, F.lit(newest).cast("timestamp_ntz")).withColumn("day", F.to_date("measurement_timestamp"))
        now = spark.table(table).where(F.col("day").isin([F.lit(d).cast("date") for d in days]))
        stays = now.join(files, same(now), "left_anti")
        _replace_days(spark, table, stays.unionByName(fresh.select(*stays.columns)), days)
        retain(spark, table, newest, "day")
    _mark(spark, table, loads)
    return {"table": table, "days": days}


def refresh_hotspots(spark: SparkSession, table: str = TABLE_HOTSPOTS, states: str = CELL_DAYS) -> dict:
    """Take the new loads, and days that retention removed or cut, into the cell states; rank the cells anew."""
    create_layers(spark)
    bronze = spark.table(TABLE_PIXELS).withColumn("day", F.col("measurement_date"))
    shape = cell_states(bronze, "day").select("lat_grid", "lon_grid", "n", "s", "n_pixels", "day")
    _create_like(shape, states)
    loads = new_loads(spark, states)
    there = sorted({p["measurement_date"] for p in partition_folders(spark, TABLE_PIXELS)})
    gone = [p["day"] for p in partition_folders(spark, states) if p["day"] not in there]
    days = sorted({*_days(bronze.join(loads, "load_no", "left_semi")), *there[:1], *gone})      # the first day may have been cut
    part = bronze.where(F.col("measurement_date").isin([F.lit(d).cast("date") for d in days])) if days else bronze.limit(0)
    _replace_days(spark, states, cell_states(part, "day"), days)
    hotspots_of(spark.table(states)).write.mode("overwrite").format("parquet").saveAsTable(table)
    _mark(spark, states, loads)
    return {"table": table, "days": days}
