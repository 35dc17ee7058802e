"""Retention that removes data (D8): whole days out of the window are dropped, the day the window starts in is rewritten.

The window ends at the newest measurement of the bronze table. Which folders are out of it is read from their names;
only the newest day (for its newest time) and the first day of the window are read, only that first day is written
again, and only where it holds rows that are too old. All other folders and their files stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumeline.model import RETENTION_DAYS, TABLE_PIXELS, TABLE_PIXELS_SILVER
from plumeline.sources.ledger import drop_folders, dynamic_overwrite, partition_folders
from plumeline.sources.tables import clustered, materialized

TIME = "measurement_timestamp"


def retained(pixels: DataFrame, days: int = RETENTION_DAYS, time_col: str = TIME) -> DataFrame:
    """The rows that retention leaves: measured at most ``days`` days before the newest measurement."""
    newest = pixels.agg(F.max(time_col)).scalar()
    return pixels.where(F.col(time_col) >= newest - F.expr(f"INTERVAL {days} DAYS"))


def newest_time(spark: SparkSession, table: str = TABLE_PIXELS, day_col: str = "measurement_date"):
    """Newest measurement, from the newest day's folders alone; None for an empty table."""
    days = sorted({p[day_col] for p in partition_folders(spark, table)}, reverse=True)
    for day in days:                                          # a folder may hold no rows
        found = spark.table(table).where(F.col(day_col) == F.lit(day).cast("date")).agg(F.max(TIME).alias("t")).first()["t"]
        if found is not None:
            return found
    return None


def retain(spark: SparkSession, table: str, newest, day_col: str = "measurement_date", days: int = RETENTION_DAYS) -> dict:
    """Remove from ``table`` the rows measured more than ``days`` days before ``newest``."""
    out = {"table": table, "dropped_folders": 0, "rewritten_folders": 0}
    if newest is None:
        return out
    cut = F.lit(newest).cast("timestamp_ntz") - F.expr(f"INTERVAL {days} DAYS")
    first = str(spark.range(1).select(F.to_date(cut).alias("d")).first()["d"])
    folders = partition_folders(spark, table)
    out["dropped_folders"] = drop_folders(spark, table, [p for p in folders if p[day_col] < first])
    keys = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    own = spark.table(table).where(F.col(day_col) == F.lit(first).cast("date"))
    counts = own.groupBy(*keys).agg(F.count_if(F.col(TIME) >= cut).alias("keep"), F.count(F.lit(1)).alias("n")).where("keep < n").collect()
    gone = [{k: str(r[k]) for k in keys} for r in counts if not r["keep"]]
    kept = [r for r in counts if r["keep"]]
    if kept:                                                  # folders of one day with rows on both sides of the cut
        touched = spark.createDataFrame([tuple(r[k] for k in keys) for r in kept], own.select(*keys).schema)
        rows = materialized(own.where(F.col(TIME) >= cut).join(F.broadcast(touched), keys, "left_semi").select(*own.columns))
        with dynamic_overwrite(spark):
            clustered(rows, keys).write.insertInto(table, overwrite=True)
        spark.catalog.refreshTable(table)
    drop_folders(spark, table, gone)
    out["dropped_folders"] += len(gone)
    out["rewritten_folders"] = len(kept)
    return out


def apply_retention(spark: SparkSession, days: int = RETENTION_DAYS) -> list[dict]:
    """Retention of the bronze and silver pixel tables, both by the newest bronze measurement."""
    newest = newest_time(spark)
    out = [retain(spark, TABLE_PIXELS, newest, "measurement_date", days)]
    if spark.catalog.tableExists(TABLE_PIXELS_SILVER):
        out.append(retain(spark, TABLE_PIXELS_SILVER, newest, "day", days))
    return out
