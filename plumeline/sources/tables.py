"""Bronze / silver / gold tables: creation, by-name appends, counts, listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumeline.model import (FACILITY_PARTITIONS, FACILITY_SCHEMA, PIXEL_PARTITIONS, PIXEL_SCHEMA,
                             TABLE_FACILITIES, TABLE_PIXELS)
from plumeline.session import cut_lineage

LAYERS = ("bronze", "silver", "gold")
BRONZE_TABLES = {TABLE_FACILITIES: (FACILITY_SCHEMA, FACILITY_PARTITIONS),
                 TABLE_PIXELS: (PIXEL_SCHEMA, PIXEL_PARTITIONS)}


def create_layers(spark: SparkSession) -> None:
    for db in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty frame with the fixed schema (never copied from an input's columns)."""
    return spark.createDataFrame([], schema)


def create_table(spark: SparkSession, name: str, schema: T.StructType, partitions: list[str]) -> None:
    """(Re)create an empty Parquet table with zstd files; every later insert uses the same codec."""
    writer = empty_like(spark, schema).write.mode("overwrite").format("parquet").option("compression", "zstd")
    (writer.partitionBy(*partitions) if partitions else writer).saveAsTable(name)


def create_bronze_tables(spark: SparkSession, replace: bool = True) -> list[str]:
    """(re)create the bronze tables with their fixed schemas, as Parquet tables partitioned by a date (reporting
    month, measurement day), so date filters prune whole folders, and by load number. A table made anew
    starts its ids and its part of the load ledger anew."""
    from plumeline.sources.ledger import create_ledger, forget

    create_layers(spark)
    create_ledger(spark)
    made = []
    for name, (schema, partitions) in BRONZE_TABLES.items():
        if replace or not spark.catalog.tableExists(name):
            create_table(spark, name, schema, partitions)
            forget(spark, name)
            made.append(name)
    return made


def materialized(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder: later steps of a job read the same rows."""
    return cut_lineage(df)


def clustered(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows brought together by partition value before a write: a value's rows land in few tasks, so few files, while
    adaptive execution splits a hot value at ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` and merges small ones."""
    return df.hint("rebalance", *keys)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns **by name** in schema order, cast to the schema types; columns
    the frame lacks become NULL. Positional inserts cannot shift columns this way."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def append_by_name(df: DataFrame, table: str) -> dict:
    """S8 + S10: append ``df`` to ``table`` by column name (the table's own column order, in
    which partition columns come last); the loaded row count is observed during the write."""
    schema = df.sparkSession.table(table).schema
    obs = Observation("load")
    observed = conform(df, schema).observe(obs, F.count(F.lit(1)).alias("rows"))
    keys = [c.name for c in df.sparkSession.catalog.listColumns(table) if c.isPartition]
    clustered(observed, keys).write.mode("append").insertInto(table)
    return {"table": table, "rows_loaded": int(obs.get["rows"])}


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite", compression: str = "zstd") -> None:
    """Parquet files with zstd, optionally partitioned (by day or month for pruning); rows of a partition value are
    brought together first, files follow the advisory partition size."""
    w = clustered(df, partition_by or []).write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def rows_for_month(spark: SparkSession, table: str, month) -> int:
    """Rows of a facility table for one reporting month (a pruned count)."""
    return spark.table(table).where(F.col("reporting_month") == F.lit(month).cast("date")).count()


def rows_by_month(spark: SparkSession, table: str, months: list) -> dict[str, int]:
    """S10 for several months: one grouped, pruned count; months without rows count 0."""
    found = {}
    if months:
        counts = spark.table(table).where(F.col("reporting_month").isin(months)).groupBy("reporting_month").count()
        found = {str(r["reporting_month"]): r["count"] for r in counts.collect()}
    return {str(m): found.get(str(m), 0) for m in months}


def row_count(spark: SparkSession, table: str) -> int:
    return spark.table(table).count()


def list_tables(spark: SparkSession, database: str = "bronze") -> list[str]:
    """Table names in a database."""
    return sorted(t.name for t in spark.catalog.listTables(database))
