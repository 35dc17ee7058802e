"""Swath granules -> pixel rows (S4), multi-file granule scans and rejects.

A granule table holds one row per block of scanlines of a swath file: ``orbit_attr`` (the file's
orbit attribute), ``file_path``, ``first_scanline`` and ``swath`` =
``array<array<struct<time, lat, lon, ch4, qa>>>`` indexed [scanline][ground_pixel]. Real products
are chunked the same way, so a row never grows with the data. Decoding HDF5 bytes is out of scope.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumeline.functions.names import orbit_from_name
from plumeline.functions.numeric import nan_to_null
from plumeline.model import BBOX, GRANULE_SCHEMA, QA_BRONZE
from plumeline.operators.filters import in_bbox, valid_swath_pixels
from plumeline.session import cut_lineage


def read_granules(spark: SparkSession, paths, skip_corrupt: bool = True) -> DataFrame:
    """Multi-file granule scan under the fixed granule schema; unreadable files are skipped, as the per-file loop does.

    The schema is given, not taken from a file: a file without a column gives NULLs there and cannot stop
    the others. ``file_faults`` names the files that such a scan gets nothing from, and why.
    """
    reader = spark.read.schema(GRANULE_SCHEMA).option("ignoreCorruptFiles", str(skip_corrupt).lower())
    return reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(*_paths(paths))


def _paths(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def granule_files(spark: SparkSession, paths) -> DataFrame:
    """(path, size) of every granule file under ``paths``, from the listing (contents are not read). A scan gives no row
    for a file without bytes; those come from the names that Spark listed for it."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
              .load(_paths(paths)))
    sized = listed.select("path", F.col("length").alias("size"))
    same = lambda c: F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:/")
    named = spark.createDataFrame([(f,) for f in listed.inputFiles()], "path string")
    silent = named.join(sized.select(same("path").alias("seen")), same("path") == F.col("seen"), "left_anti")
    return sized.unionByName(silent.withColumn("size", F.lit(0).cast("long")))


def content_hashes(granules: DataFrame) -> DataFrame:
    """(path, content_hash) of the landing files that give rows: a checksum of all their rows, in any order."""
    own = F.xxhash64("orbit_attr", "file_path", "first_scanline", "swath")
    return granules.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.concat_ws("-", F.count(F.lit(1)), F.hex(F.bit_xor(own)), F.hex(F.sum(F.shiftright(own, 20)))).alias("content_hash"))


def file_faults(spark: SparkSession, paths, granules: DataFrame | None = None) -> DataFrame:
    """(path, reason) of the files under ``paths`` that no pixel can come from, with one reason each.

    ``empty_file`` (no bytes), ``not_parquet`` (no Parquet marks at both ends: cut off, or another format),
    ``unreadable`` (Parquet marks, but no row can be read), ``no_rows`` (a whole file without rows) and
    ``missing_variable`` (rows, but no swath data in any). Files that give rows are told by one aggregate; only
    the few others are looked into: first their first and last bytes, then a scan that reads no column.
    """
    granules = read_granules(spark, paths) if granules is None else granules
    files = granule_files(spark, paths)
    seen = granules.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("swath").alias("with_data"))
    known = files.join(seen, "path", "left")
    silent = cut_lineage(known.where(F.coalesce("with_data", F.lit(0)) == 0))
    odd = [r["path"] for r in silent.where(F.col("with_data").isNull() & (F.col("size") > 0)).select("path").collect()]
    if odd:
        mark = F.lit("PAR1").cast("binary")
        ends = (spark.read.format("binaryFile").load(odd)
                .select("path", ((F.substring("content", 1, 4) == mark) & (F.substring("content", -4, 4) == mark)).alias("marked")))
        opened = (spark.read.format("parquet").schema("unused int").option("ignoreCorruptFiles", "false").load)
        whole = [p for p in (r["path"] for r in ends.where("marked").collect()) if _opens(opened, p)]
        looked = ends.withColumn("whole", F.col("path").isin(whole))
    else:
        looked = silent.limit(0).select("path", F.lit(False).alias("marked"), F.lit(False).alias("whole"))
    reason = (F.when(F.col("size") == 0, "empty_file").when(F.col("with_data") == 0, "missing_variable")
              .when(~F.col("marked"), "not_parquet").when(F.col("whole"), "no_rows").otherwise("unreadable"))
    return silent.join(looked, "path", "left").select("path", reason.alias("reason"))


def _opens(opened, path: str) -> bool:
    """Whether a file with Parquet marks can be read and has no rows."""
    try:
        return opened(path).count() == 0
    except Exception:  # noqa: BLE001 - any failure to read it is the answer
        return False


def with_orbit(granules: DataFrame) -> DataFrame:
    return granules.withColumn("orbit", orbit_from_name(F.col("file_path"), F.col("orbit_attr")))


def flatten_swath(granules: DataFrame, apply_filters: bool = True, keep: tuple = ()) -> DataFrame:
    """One row per pixel with its scanline and ground_pixel; bbox and validity filters applied. ``keep`` names
    further columns of the granule rows to carry along.

    Pixels of a granule without an orbit tag or attribute are kept with a NULL orbit.
    """
    g = with_orbit(granules).where(F.col("swath").isNotNull())
    lines = g.select("file_path", "orbit", "first_scanline", *keep,
                     F.posexplode("swath").alias("line_pos", "line"))
    pixels = lines.select(
        "file_path", "orbit", *keep,
        (F.col("first_scanline") + F.col("line_pos")).cast("long").alias("scanline"),
        F.posexplode("line").alias("ground_pixel", "p"))
    out = pixels.select(
        F.col("p.time").alias("time"),
        nan_to_null(F.col("p.lat")).alias("lat"),
        nan_to_null(F.col("p.lon")).alias("lon"),
        nan_to_null(F.col("p.ch4")).alias("ch4"),
        nan_to_null(F.col("p.qa")).alias("qa"),
        F.col("scanline"),
        F.col("ground_pixel").cast("long").alias("ground_pixel"),
        F.col("orbit").cast("int").alias("orbit"),
        F.col("file_path").alias("source_file"),
        *keep,
    )
    if apply_filters:
        out = valid_swath_pixels(in_bbox(out, "lat", "lon"))
    return out


def _kept_pixels(swath: str) -> Column:
    """Pixels of one block that the flattening keeps (the same filters, on the array)."""
    def kept(p: Column) -> Column:
        lat, lon, ch4, qa = (nan_to_null(p[c]) for c in ("lat", "lon", "ch4", "qa"))
        return (lat.between(BBOX["min_lat"], BBOX["max_lat"]) & lon.between(BBOX["min_lon"], BBOX["max_lon"])
                & ch4.isNotNull() & (qa >= F.lit(QA_BRONZE)) & p["time"].isNotNull())
    return F.aggregate(F.col(swath), F.lit(0).cast("long"), lambda n, line: n + F.size(F.filter(line, kept)))


def granule_load_report(granules: DataFrame) -> DataFrame:
    """Per file: orbit, blocks, pixels kept after filtering, a status and a note.

    status is ``missing_variable`` (no swath data), ``empty`` (nothing survives the filters) or
    ``loaded``; the note is ``no_orbit`` if neither the name nor the attribute has one. One pass: kept
    pixels are counted per block on the array, then summed per file.
    """
    rep = with_orbit(granules).groupBy("file_path").agg(
        F.max("orbit").alias("orbit"), F.count(F.lit(1)).alias("blocks"), F.count("swath").alias("_with_data"),
        F.coalesce(F.sum(_kept_pixels("swath")), F.lit(0)).cast("long").alias("pixels_kept"))
    status = (F.when(F.col("_with_data") == 0, F.lit("missing_variable"))
              .when(F.col("pixels_kept") == 0, F.lit("empty")).otherwise(F.lit("loaded")))
    return rep.select("file_path", "orbit", "blocks", "pixels_kept", status.alias("status"),
                      F.when(F.col("orbit").isNull(), F.lit("no_orbit")).alias("note"))


def rejected_granules(granules: DataFrame) -> DataFrame:
    return granule_load_report(granules).where(F.col("status") != "loaded")
