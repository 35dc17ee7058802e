"""Incremental ingest of a landing folder with Structured Streaming.

A file-source stream over the landing folder hands each micro-batch the rows of files it has
not seen; its checkpoint records which files were committed, so re-running a load never appends
the same file twice (the batch loaders append blindly, as the original scripts do). A swath file's blocks
may arrive in several landing files and micro-batches, or twice in one; a micro-batch keeps one row per *pixel* (file,
scanline, ground pixel) and skips the pixels that are already in the table, so each pixel lands exactly once. That
test reads only the partitions (days) the micro-batch has pixels for. A micro-batch that died half-way is known
by its name in the load ledger and taken back before it is tried again.
``trigger(availableNow=True)`` processes what is there and stops, so this runs as a scheduled job.

Battery CSVs need their own preamble handling per file, so each micro-batch resolves the set of
new file paths (bounded by ``max_files_per_trigger``) and runs the batch loader on exactly
those files. Granule Parquet is appended straight from the stream.
"""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumeline.model import TABLE_FACILITIES, TABLE_PIXELS
from plumeline.operators.medallion import PIXEL_KEY
from plumeline.sources.ingest import bronze_pixel_columns, load_battery_files, load_pixel_batch
from plumeline.sources.ledger import take_back


def _run(spark: SparkSession, query, table: str) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    # Micro-batches write through the stream's own session; make this one see the new files.
    spark.catalog.refreshTable(table)


def append_new_granules(session: SparkSession, granules: DataFrame, table: str = TABLE_PIXELS, batch: str | None = None) -> dict:
    """Load the pixels of ``granules`` that are not yet in ``table``, each once however often the batch has it; ids go on
    after the highest ever given out. Running it again with the same granules loads nothing. ``batch`` names the load in
    the ledger: a batch of that name that died is taken back first."""
    session.catalog.refreshTable(table)
    pixels = bronze_pixel_columns(granules)
    days = [r.d for r in pixels.select(F.col("measurement_date").alias("d")).distinct().collect()]   # days of one micro-batch
    if not days:
        return {"table": table, "rows_loaded": 0}
    batch = batch or f"rows:{uuid4()}"
    take_back(session, table, batch)                          # before its rows could count as loaded
    loaded = session.table(table).where(F.col("measurement_date").isin(days)).select(*[F.col(k).alias("_l_" + k) for k in PIXEL_KEY])
    same = reduce(lambda a, b: a & b, [pixels[k].eqNullSafe(loaded["_l_" + k]) for k in PIXEL_KEY])
    return load_pixel_batch(session, pixels.join(loaded, same, "left_anti"), batch, table)


def ingest_battery_landing(spark: SparkSession, landing_dir: str, checkpoint_dir: str,
                           table: str = TABLE_FACILITIES, pattern: str = "*.csv",
                           max_files_per_trigger: int = 64, mode: str = "as_written",
                           rejects_path: str | None = None) -> list[dict]:
    """Load every not-yet-loaded monthly CSV under ``landing_dir`` into ``table``.

    Files without the required columns or month do not stop the stream: they are counted per batch under
    ``rows_rejected`` and, with the rejected rows, appended to ``rejects_path`` if one is given.
    """
    results: list[dict] = []
    # One row per new file; the binaryFile source does not read file contents unless asked to.
    lines = (spark.readStream.format("binaryFile")
             .schema("path string, modificationTime timestamp, length long, content binary")
             .option("pathGlobFilter", pattern)
             .option("maxFilesPerTrigger", max_files_per_trigger).load(landing_dir)
             .select("path"))

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        paths = sorted(r.path for r in batch.select("path").distinct().collect())   # <= max_files_per_trigger
        if paths:
            results.append({"batch": batch_id, "files": len(paths),
                            **load_battery_files(batch.sparkSession, paths, table=table, mode=mode,
                                                 skip_loaded_files=True, bad_files="reject",
                                                 rejects_path=rejects_path)})

    q = (lines.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    _run(spark, q, table)
    return results


def ingest_granule_landing(spark: SparkSession, landing_dir: str, checkpoint_dir: str, schema,
                           table: str = TABLE_PIXELS, max_files_per_trigger: int = 256) -> list[dict]:
    """Append pixels of not-yet-loaded granule Parquet files under ``landing_dir``; ids go on after the highest id given
    out for the table."""
    results: list[dict] = []
    granules = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
                .option("ignoreCorruptFiles", "true").parquet(landing_dir))

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        results.append({"batch": batch_id, **append_new_granules(batch.sparkSession, batch, table, f"{checkpoint_dir}#{batch_id}")})

    q = (granules.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    _run(spark, q, table)
    return results
