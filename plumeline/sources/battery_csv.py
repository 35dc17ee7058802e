"""Monthly battery CSV scan.

File layout: line 1 a title, line 2 the header, line 3 units, data from line 4. Columns are found by name
in each file's own header, in any order; files of one load may have different layouts. Files are
split across tasks like any text, quoted fields may hold line breaks (``csv_records``); the first lines of a file are found from their position within
its first split, never by a global row position. A file is identified by its full path.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumeline.functions.names import month_from_name
from plumeline.functions.numeric import is_fractional, lenient_double, lenient_int
from plumeline.model import BATTERY_CSV_COLUMNS, REQUIRED_CSV_COLUMN
from plumeline.sources.csv_records import csv_records

NUMERIC_DOUBLE = ("oil_prod_m3", "gas_prod_1000m3", "gas_flared_1000m3", "gas_vented_1000m3", "water_prod_m3")
NUMERIC_INT = ("total_wells",)
TARGETS = [t for _, t in BATTERY_CSV_COLUMNS]


class CsvLayoutError(ValueError):
    pass


def paths_of(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def header_positions(header_line: str) -> dict[str, int]:
    """Map normalized column name -> position from one header line."""
    names = [h.strip() for h in next(csv.reader(io.StringIO(header_line)), [])]
    if REQUIRED_CSV_COLUMN not in names:
        raise CsvLayoutError(f"Expected column '{REQUIRED_CSV_COLUMN}' not found")
    seen: dict[str, int] = {}
    out: dict[str, int] = {}
    for source, target in BATTERY_CSV_COLUMNS:
        start = seen.get(source, -1) + 1
        try:
            pos = names.index(source, start)
        except ValueError:
            continue   # optional column absent: it stays NULL
        seen[source] = pos
        out[target] = pos
    out["_width"] = len(names)
    return out


def battery_files(spark: SparkSession, paths) -> DataFrame:
    """(path, source_file) of every file under ``paths``, from the listing (contents are not read)."""
    listed = spark.read.format("binaryFile").load(paths_of(paths)).select("path")
    return listed.select("path", F.element_at(F.split("path", "/"), -1).alias("source_file"))


def _lines(spark: SparkSession, paths) -> DataFrame:
    return spark.read.text(paths_of(paths)).select(
        "value", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_block_start").alias("_line_block"), F.monotonically_increasing_id().alias("_line_pos"))


def read_battery_files(spark: SparkSession, paths, bad_files: str = "raise") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(typed rows, files, unclosed): rows of all good files, (path, source_file, header, reason) of every file, and
    (path, source_file, value) of the first line of a record that its file ends without closing the quotes of.

    A record may span lines inside a quoted field, over the borders of splits (``csv_records``).

    ``reason`` is NULL for a good file, ``no_required_column`` if line 2 lacks the location column (or there is
    no line 2) and ``no_month_in_name`` if the file name carries none. With ``bad_files="raise"``
    such a file raises; with "reject" it only appears in the second result.
    """
    lines = _lines(spark, paths)
    # Line 2 of each file: the second smallest position of its first split.
    top = lines.where(F.col("_line_block") == 0).groupBy("_path").agg(F.min("_line_pos").alias("_first"))
    second = lines.where(F.col("_line_block") == 0).join(top, "_path").where(F.col("_line_pos") == F.col("_first") + 1)
    heads = battery_files(spark, paths).join(second.select(F.col("_path").alias("path"), "_first", F.col("value").alias("header")), "path", "left")
    # Distinct layouts, not files, come to the driver; their positions go back as a small table.
    layouts = []
    for r in heads.select("header").distinct().collect():
        try:
            pos = header_positions(r["header"] or "")
            layouts.append((r["header"], pos["_width"], [pos.get(t, -1) for t in TARGETS]))
        except CsvLayoutError:
            continue
    known = spark.createDataFrame(layouts, "known string, _width int, _at array<int>")
    reason = (F.when(F.col("_at").isNull(), F.lit("no_required_column"))
              .when(month_from_name("source_file").isNull(), F.lit("no_month_in_name")))
    files = heads.join(known, heads["header"].eqNullSafe(known["known"]), "left").withColumn("reason", reason)
    if bad_files == "raise":
        bad = files.where(F.col("reason").isNotNull()).select("path", "reason").orderBy("path").limit(5).collect()
        if any(r["reason"] == "no_required_column" for r in bad):
            raise CsvLayoutError(f"Expected column '{REQUIRED_CSV_COLUMN}' not found in {[r['path'] for r in bad]}")
        if bad:
            raise ValueError(f"Could not extract reporting month from file name(s): {[r['path'] for r in bad]}")
    good = files.where(F.col("reason").isNull()).select(F.col("path").alias("_file"), "_first", "_at")
    width = max([w for _, w, _ in layouts], default=1)
    body = lines.join(good, lines["_path"] == good["_file"]).where((F.col("_line_block") > 0) | (F.col("_line_pos") > F.col("_first") + 2))
    body, unclosed = csv_records(body)
    body = body.where(F.trim("value") != "")
    names = [f"c{i}" for i in range(width)]
    parsed = body.withColumn("_row", F.from_csv("value", ", ".join(f"{n} string" for n in names), {"mode": "PERMISSIVE", "escape": "\""}))
    cells = parsed.withColumn("_cells", F.array(*[F.col(f"_row.{n}") for n in names]))

    cols = []
    for i, target in enumerate(TARGETS):
        at = F.get("_at", F.lit(i))
        src = F.when(at >= 0, F.get("_cells", at))
        if target in NUMERIC_DOUBLE:
            cols.append(lenient_double(src).alias(target))
        elif target in NUMERIC_INT:
            cols.append(lenient_int(src).alias(target))
            cols.append(is_fractional(src).alias("_fractional_" + target))
        else:
            cols.append(F.nullif(F.trim(src), F.lit("")).alias(target))
    # ``inline`` of one struct: later filters read the typed values, they are not pushed into copies of the parser.
    rows = cells.select("_path", "source_file", "_line_block", "_line_pos", F.inline(F.array(F.struct(*cols))))
    rows = rows.select(*[c for c in rows.columns if c not in ("_path", "source_file", "_line_block", "_line_pos")],
                       "_path", "source_file", month_from_name("source_file").alias("reporting_month"),
                       F.current_date().alias("ingestion_date"), "_line_block", "_line_pos")
    return rows, files.select("path", "source_file", "header", "reason"), unclosed.select(F.col("_path").alias("path"), "source_file", "value")


def read_battery_csv(spark: SparkSession, paths, with_line_order: bool = True) -> DataFrame:
    """Typed, normalized rows of one or more monthly CSV files; raises for a file without month or location column.

    Adds ``source_file``, ``reporting_month`` (from the file name), ``ingestion_date`` and
    ``_line_block`` / ``_line_pos`` (file order) for per-file row numbers.
    """
    rows, _, _ = read_battery_files(spark, paths)
    return rows if with_line_order else rows.drop("_path", "_line_block", "_line_pos")


def months_in_names(paths) -> list[str]:
    """Reporting months (``YYYY-MM-01``) named by the files; raises when a name has none."""
    import re

    from plumeline.model import REPORT_MONTH_RE
    months, bad = set(), []
    for p in paths_of(paths):
        m = re.search(REPORT_MONTH_RE, p.rsplit("/", 1)[-1])
        if m and 1 <= int(m.group(2)) <= 12:
            months.add(f"{m.group(1)}-{m.group(2)}-01")
        else:
            bad.append(p)
    if bad:
        raise ValueError(f"Could not extract reporting month from file name(s): {bad}")
    return sorted(months)


def check_month_in_names(paths) -> None:
    """Fail before reading when a file name has no ``YYYY[_-]MM`` month."""
    months_in_names(paths)
