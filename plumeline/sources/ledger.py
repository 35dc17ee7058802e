"""Load ledger, id blocks and staged loads.

Every load has a number. Its rows carry that number as a partition column, so the rows of one load are whole folders:
they can be taken back without touching another load's files.

A load goes through these steps, each recorded as rows of the ledger (one row per file and step):

1. ``started``   the files with their size and content hash; from now on the load number is taken.
2. staging       the rows are written to the staging table, under the load number. Nobody reads them there.
3. audit         gates run on the staged rows; their rows are kept under the load number. If one FAILED, the load ends as
                 ``failed`` and bronze never sees the batch.
4. publish       ids come from a block of their own, the rows are written into folders of their own.
5. ``committed`` with the rows and rejects of each file.

A job that dies leaves its files ``started``. The next load that has one of these files takes the dead load back (drops
its folders in the target, the rejects and the staging table, and records ``rolled_back``) before it starts its own, so a
retry after any step gives each file once. Loads of other files are not touched; two of them may run at once. A file
is the same one if its path and its content are the same.

Numbers come from an allocator of blocks: a folder of claims on the shared storage of the warehouse, one file
per block, created exclusively. The highest claim is the high-water mark, whatever rows still exist, so ids do not
repeat after rows were removed, and two claimers cannot get one block.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEDGER = "ops.load_ledger"
AUDITS = "ops.load_audits"
REJECTS = "ops.load_rejects"
STAGING = "staging"

LEDGER_SCHEMA = T.StructType([
    T.StructField("target", T.StringType()), T.StructField("load_no", T.LongType()), T.StructField("path", T.StringType()),
    T.StructField("size", T.LongType()), T.StructField("content_hash", T.StringType()), T.StructField("rows", T.LongType()),
    T.StructField("rejects", T.LongType()), T.StructField("status", T.StringType()), T.StructField("recorded_at", T.TimestampType())])
AUDIT_SCHEMA = T.StructType([
    T.StructField("target", T.StringType()), T.StructField("check", T.StringType()), T.StructField("value", T.DoubleType()),
    T.StructField("status", T.StringType()), T.StructField("load_no", T.LongType())])
REJECT_SCHEMA = T.StructType([
    T.StructField("target", T.StringType()), T.StructField("source_path", T.StringType()), T.StructField("source_file", T.StringType()),
    T.StructField("record", T.StringType()), T.StructField("reason", T.StringType()), T.StructField("load_no", T.LongType())])

#: Numbers left out after a claim whose owner died before it wrote how many it takes; no block is larger.
DEAD_CLAIM = 1 << 40
#: States in order; the furthest one a file of a load has reached counts.
STATES = ("started", "committed", "failed", "rolled_back")


class LoadFailed(RuntimeError):
    """A gate FAILED on a staged load; ``checks`` names them, ``load_no`` finds their rows in the audit table."""

    def __init__(self, target: str, load_no: int, checks: list[str]):
        super().__init__(f"load {load_no} of {target} failed its gates: {', '.join(checks)}")
        self.load_no, self.checks = load_no, checks


# ---- shared storage ---------------------------------------------------------------------------------------------

def _path(spark: SparkSession, where: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def allocate(spark: SparkSession, sequence: str, count: int, home: str | None = None) -> int:
    """First number of a new block of ``count`` numbers of ``sequence`` (numbers start at 1); nobody else gets one of them.

    ``home`` is the folder of the claims, by default beside the warehouse's tables.
    """
    home = home or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_claims"
    fs, folder = _path(spark, f"{home}/{sequence}")
    fs.mkdirs(folder)
    while True:
        starts = sorted(int(f.getPath().getName()) for f in fs.listStatus(folder) if f.getPath().getName().isdigit())
        first = 1
        if starts:
            claim = spark._jvm.org.apache.hadoop.fs.Path(folder, f"{starts[-1]:020d}")
            size = _claimed(fs, claim)
            if size is None and time.time() * 1000 - fs.getFileStatus(claim).getModificationTime() < 60_000:
                time.sleep(0.05)                              # its owner is writing it right now
                continue
            size = DEAD_CLAIM if size is None else size
            first = starts[-1] + size
        own = spark._jvm.org.apache.hadoop.fs.Path(folder, f"{first:020d}")
        try:
            out = fs.create(own, False)
        except Exception:  # noqa: BLE001 - the file exists: another load claimed this start, look again
            if not fs.exists(own):
                raise
            continue
        out.write(bytearray(f"{count};".encode()))
        out.close()
        return first


def _claimed(fs, claim) -> int | None:
    with_end = bytearray()
    stream = fs.open(claim)
    while (b := stream.read()) >= 0:
        with_end.append(b)
    stream.close()
    text = bytes(with_end).decode()
    return int(text[:-1]) if text.endswith(";") else None


def high_water(spark: SparkSession, sequence: str, home: str | None = None) -> int:
    """The highest number given out so far (0: none)."""
    home = home or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_claims"
    fs, folder = _path(spark, f"{home}/{sequence}")
    if not fs.exists(folder):
        return 0
    starts = sorted(int(f.getPath().getName()) for f in fs.listStatus(folder) if f.getPath().getName().isdigit())
    if not starts:
        return 0
    size = _claimed(fs, spark._jvm.org.apache.hadoop.fs.Path(folder, f"{starts[-1]:020d}"))
    return starts[-1] + (DEAD_CLAIM if size is None else size) - 1


def partition_folders(spark: SparkSession, table: str) -> list[dict[str, str]]:
    """Partition values of a table as strings, one dict per folder, from the folder names alone."""
    keys = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    fs, root = _path(spark, table_location(spark, table))
    out: list[dict[str, str]] = []
    if not keys or not fs.exists(root):
        return out
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName

    def walk(path, found: dict[str, str]) -> None:
        if len(found) == len(keys):
            out.append(found)
            return
        for f in fs.listStatus(path):
            name, _, value = f.getPath().getName().partition("=")
            if f.isDirectory() and name == keys[len(found)]:
                walk(f.getPath(), {**found, name: unescape(value)})

    walk(root, {})
    return out


def drop_folders(spark: SparkSession, table: str, folders: list[dict[str, str]]) -> int:
    """Remove whole partition folders of a table; nothing else is read or written."""
    location = table_location(spark, table)
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    tracked = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Partition Provider' and data_type = 'Catalog'").count() > 0
    if tracked:
        for i in range(0, len(folders), 200):
            specs = ", ".join("PARTITION (" + ", ".join(f"{k} = '{v}'" for k, v in values.items()) + ")" for values in folders[i:i + 200])
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    for values in folders:                                    # what the catalog did not know or did not own
        fs, folder = _path(spark, "/".join([location, *(f"{k}={escape(v)}" for k, v in values.items())]))
        if fs.exists(folder):
            fs.delete(folder, True)
            if fs.exists(folder):
                raise OSError(f"could not remove {folder.toString()}")
    spark.catalog.refreshTable(table)
    return len(folders)


def drop_load(spark: SparkSession, table: str, load_no: int) -> int:
    """Remove every folder of one load."""
    if not spark.catalog.tableExists(table):
        return 0
    return drop_folders(spark, table, [p for p in partition_folders(spark, table) if p.get("load_no") == str(load_no)])


# ---- the ledger -------------------------------------------------------------------------------------------------

def create_ledger(spark: SparkSession, replace: bool = False) -> None:
    from plumeline.sources.tables import create_table

    for db in ("bronze", "ops", STAGING):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    for name, schema, parts in ((LEDGER, LEDGER_SCHEMA, []), (AUDITS, AUDIT_SCHEMA, ["load_no"]), (REJECTS, REJECT_SCHEMA, ["load_no"])):
        if replace or not spark.catalog.tableExists(name):
            create_table(spark, name, schema, parts)


def _record(spark: SparkSession, files: DataFrame, target: str, load_no: int, status: str) -> None:
    """Ledger rows of a step; ``files`` has path, size, content_hash and, if known, rows and rejects."""
    from plumeline.sources.tables import conform

    named = files.withColumns({"target": F.lit(target), "load_no": F.lit(load_no), "status": F.lit(status), "recorded_at": F.current_timestamp()})
    conform(named, LEDGER_SCHEMA).write.mode("append").insertInto(LEDGER)
    spark.catalog.refreshTable(LEDGER)


def forget(spark: SparkSession, target: str) -> None:
    """Start a table's ids and loads anew (the table was made anew): its loads so far count as rolled back."""
    states = load_states(spark, target).where("status <> 'rolled_back'")
    named = states.withColumns({"target": F.lit(target), "status": F.lit("rolled_back"), "recorded_at": F.current_timestamp()})
    from plumeline.sources.tables import conform, materialized

    conform(materialized(named), LEDGER_SCHEMA).write.mode("append").insertInto(LEDGER)
    spark.catalog.refreshTable(LEDGER)
    fs, folder = _path(spark, spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + f"/_claims/ids/{target}")
    if fs.exists(folder):
        fs.delete(folder, True)


def load_states(spark: SparkSession, target: str) -> DataFrame:
    """(load_no, path, size, content_hash, rows, rejects, status): the last state of each file of each load of ``target``."""
    order = F.array_position(F.array(*[F.lit(s) for s in STATES]), F.col("status"))
    return (spark.table(LEDGER).where(F.col("target") == target).groupBy("load_no", "path").agg(
        *[F.max_by(c, order).alias(c) for c in ("size", "content_hash", "rows", "rejects", "status")]))


def committed(spark: SparkSession, table: str) -> DataFrame:
    """Rows of ``table`` whose load is committed: what a reader sees while a load is being published."""
    done = load_states(spark, table).where("status = 'committed'").select("load_no").distinct()
    return spark.table(table).join(done, "load_no", "left_semi")


def roll_back(spark: SparkSession, target: str, load_no: int) -> None:
    """Take a load back: its rows, rejects and staged rows go; its audit rows stay."""
    for table in (target, staging_name(target), REJECTS):
        drop_load(spark, table, load_no)
    files = load_states(spark, target).where((F.col("load_no") == load_no) & (F.col("status") == "started"))
    _record(spark, files.select("path", "size", "content_hash"), target, load_no, "rolled_back")


def take_back(spark: SparkSession, target: str, *paths: str) -> None:
    """Roll back the unfinished loads of ``target`` that hold one of ``paths``."""
    create_ledger(spark)
    dead = load_states(spark, target).where((F.col("status") == "started") & F.col("path").isin(list(paths))).select("load_no").distinct()
    for r in dead.orderBy("load_no").collect():
        roll_back(spark, target, r["load_no"])


def staging_name(target: str) -> str:
    return f"{STAGING}.{target.replace('.', '_')}"


def write_load(df: DataFrame, table: str) -> None:
    """Write the rows of a load under its own number, which no other rows have: an append into new folders."""
    from plumeline.sources.tables import clustered, conform

    spark = df.sparkSession
    keys = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    clustered(conform(df, spark.table(table).schema), keys).write.insertInto(table)
    spark.catalog.refreshTable(table)


@contextmanager
def dynamic_overwrite(spark: SparkSession):
    """Overwrites replace the partitions that the written rows have, no others."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def staged_load(spark: SparkSession, target: str, files: DataFrame, rows: Callable[[DataFrame], tuple[DataFrame, DataFrame]], *,
                number: Callable[[DataFrame, int], DataFrame] | None = None, gates: Callable[[DataFrame], DataFrame] | None = None,
                skip_loaded: bool = True) -> dict:
    """Load ``files`` (path, size, content_hash) into ``target`` by the steps above.

    ``rows(files)`` gives (rows, rejects) of the files that are loaded; rows carry ``source_path``, rejects
    are rows of the reject schema. ``number(rows, start)`` numbers the staged rows after ``start``; ``gates(rows)`` gives
    (check, value, status) rows. With ``skip_loaded`` files whose path and content are committed are left out.
    """
    from plumeline.sources.tables import create_table, materialized

    create_ledger(spark)
    files = materialized(files.select("path", "size", "content_hash").distinct())
    states = load_states(spark, target)
    dead = states.where("status = 'started'").join(files.select("path"), "path", "left_semi").select("load_no").distinct()
    for r in dead.orderBy("load_no").collect():               # unfinished loads that hold a file of this one
        roll_back(spark, target, r["load_no"])
    skipped = files.limit(0)
    if skip_loaded:
        done = load_states(spark, target).where("status = 'committed'").select("path", "content_hash").distinct()
        same = (files["path"] == done["path"]) & files["content_hash"].eqNullSafe(done["content_hash"])
        skipped = materialized(files.join(done, same, "left_semi"))
        files = materialized(files.join(done, same, "left_anti"))
    result = {"table": target, "load_no": None, "rows_loaded": 0, "rows_rejected": {}, "files_loaded": 0,
              "files_skipped": [r["path"] for r in skipped.orderBy("path").limit(1000).collect()]}
    if files.isEmpty():
        return result
    load_no = allocate(spark, "load_no", 1)
    result["load_no"] = load_no
    _record(spark, files, target, load_no, "started")

    try:
        made, rejects = rows(files)
    except Exception:                                         # an input that cannot be read as asked: nothing was written
        roll_back(spark, target, load_no)
        raise
    staging = staging_name(target)
    schema = T.StructType([*[f for f in spark.table(target).schema.fields if f.name not in ("load_no", "source_path")],
                           T.StructField("source_path", T.StringType()), T.StructField("load_no", T.LongType())])
    if not spark.catalog.tableExists(staging):
        create_table(spark, staging, schema, ["load_no"])
    write_load(made.withColumn("load_no", F.lit(load_no)), staging)
    rejects = rejects.withColumns({"target": F.lit(target), "load_no": F.lit(load_no)})
    write_load(rejects, REJECTS)
    staged = spark.table(staging).where(F.col("load_no") == load_no)
    refused = spark.table(REJECTS).where(F.col("load_no") == load_no)

    if gates is not None:
        write_load(gates(staged).withColumns({"target": F.lit(target), "load_no": F.lit(load_no)}), AUDITS)
        failed = [r["check"] for r in spark.table(AUDITS).where((F.col("load_no") == load_no) & (F.col("status") == "FAILED")).collect()]
        if failed:
            _record(spark, files, target, load_no, "failed")
            drop_load(spark, staging, load_no)
            raise LoadFailed(target, load_no, sorted(failed))

    per_file = materialized(staged.groupBy(F.col("source_path").alias("path")).agg(F.count(F.lit(1)).alias("rows")))
    n = per_file.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).first()["n"]
    publish = staged
    if number is not None:
        publish = number(staged, allocate(spark, f"ids/{target}", n) - 1 if n else 0)
    if n:
        write_load(publish, target)
    per_reject = refused.groupBy(F.col("source_path").alias("path")).agg(F.count(F.lit(1)).alias("rejects"))
    counted = files.join(per_file, "path", "left").join(per_reject, "path", "left").na.fill(0, ["rows", "rejects"])
    _record(spark, counted, target, load_no, "committed")
    drop_load(spark, staging, load_no)
    result["rows_loaded"] = int(n)
    result["files_loaded"] = files.count()
    result["rows_rejected"] = {r["reason"]: r["n"] for r in refused.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).collect()}
    return result
