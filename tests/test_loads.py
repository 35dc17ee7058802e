"""The load ledger, staged loads, id blocks, retention, split CSV records and clustered writes, on small files."""

import csv
import io
import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from plumeline.model import GRANULE_SCHEMA, TABLE_FACILITIES, TABLE_PIXELS
from plumeline.sources import battery_csv, ingest, ledger, retention, swath, tables
from plumeline.streaming.incremental import append_new_granules
from tests.test_sources import _write

LINE = "{0},F1,OP A,T1,d,02-21-065-04W4,1,20,1,1,1,1"


def granules(spark, blocks):
    """Granule rows of (file, first scanline, days, pixels per line)."""
    rows = []
    for name, first, days, n in blocks:
        swath_rows = [[{"time": None, "lat": 50.0 + d / 100, "lon": -115.0 - g / 100, "ch4": 1800.0 + d, "qa": 0.9} for g in range(n)] for d in days]
        rows.append((7, name, first, swath_rows, days))
    df = spark.createDataFrame([r[:4] for r in rows], GRANULE_SCHEMA)
    days = {(r[1], r[2]): r[4] for r in rows}
    at = F.create_map(*[x for (f, s), d in days.items() for x in (F.lit(f"{f}:{s}"), F.array(*[F.lit(v) for v in d]))])
    own = at[F.concat_ws(":", "file_path", "first_scanline")]
    stamped = F.transform("swath", lambda line, i: F.transform(line, lambda p: p.withField(
        "time", (F.lit("2024-01-01 12:00:00").cast("timestamp_ntz") + F.make_dt_interval(days=F.element_at(own, i + 1))))))
    return df.withColumn("swath", stamped.cast(GRANULE_SCHEMA["swath"].dataType)).select(*GRANULE_SCHEMA.names)


@pytest.fixture()
def bronze(spark):
    tables.create_bronze_tables(spark)
    return spark


def keys(spark):
    return sorted(tuple(r) for r in spark.table(TABLE_PIXELS).select("file_path", "scanline", "ground_pixel").collect())


def test_a_block_delivered_twice_in_one_batch_lands_once(bronze):
    g = granules(bronze, [("a.nc", 0, [0, 1], 2)])
    assert append_new_granules(bronze, g.unionByName(g))["rows_loaded"] == 4
    assert append_new_granules(bronze, g)["rows_loaded"] == 0
    assert ingest.load_granules(bronze, granules(bronze, [("b.nc", 0, [0], 3)] * 3))["rows_loaded"] == 3
    assert len(keys(bronze)) == len(set(keys(bronze))) == 7


def test_faulty_granule_files_are_rejects_with_their_reason(bronze, scratch):
    folder = os.path.join(scratch, "granules")
    granules(bronze, [("good.nc", 0, [0, 1], 3)]).coalesce(1).write.parquet(folder)
    good = next(os.path.join(folder, f) for f in os.listdir(folder) if f.endswith(".parquet"))
    raw = open(good, "rb").read()
    for name, data in (("cut.parquet", raw[:300]), ("none.parquet", b""), ("text.parquet", b"not a parquet file at all"),
                       ("footer.parquet", raw[:4] + b"\x00" * 60 + raw[-8:])):
        with open(os.path.join(folder, name), "wb") as fh:
            fh.write(data)
    bronze.createDataFrame([(1, "x.nc")], "orbit_attr int, file_path string").coalesce(1).write.mode("append").parquet(folder)
    bare = granules(bronze, [("empty.nc", 0, [0], 1)]).limit(0).coalesce(1)
    bare.write.parquet(os.path.join(scratch, "bare"))
    for f in os.listdir(os.path.join(scratch, "bare")):
        if f.endswith(".parquet"):
            with open(os.path.join(scratch, "bare", f), "rb") as src, open(os.path.join(folder, "norows.parquet"), "wb") as out:
                out.write(src.read())
    res = ingest.load_granules(bronze, folder, skip_loaded_files=True)
    assert res["rows_loaded"] == 6
    reasons = {os.path.basename(p): r for p, r in res["rejects"].items()}
    column_less = [n for n, r in reasons.items() if r == "missing_variable"]
    assert len(column_less) == 1 and len(reasons) == 6
    assert reasons["none.parquet"] == "empty_file" and reasons["cut.parquet"] == reasons["text.parquet"] == "not_parquet"
    assert reasons["footer.parquet"] == "unreadable" and reasons["norows.parquet"] == "no_rows"
    stored = bronze.table(ledger.REJECTS).where(F.col("load_no") == res["load_no"])
    assert {r.reason for r in stored.collect()} == set(reasons.values())
    again = ingest.load_granules(bronze, folder, skip_loaded_files=True)
    assert again["rows_loaded"] == 0 and again["load_no"] is None and len(again["files_skipped"]) == 7


def test_files_of_one_name_and_changed_files_load_once_each(bronze, scratch):
    folders = [os.path.join(scratch, x) for x in "xy"]
    for f in folders:
        os.makedirs(f)
    a, b = (_write(f, "ST60_2024-02.csv", [LINE.format(f"ABBT{i}")]) for i, f in enumerate(folders))
    assert ingest.load_battery_files(bronze, [a, b], skip_loaded_files=True)["rows_loaded"] == 2
    assert ingest.load_battery_files(bronze, [a, b], skip_loaded_files=True)["rows_loaded"] == 0
    _write(folders[0], "ST60_2024-02.csv", ["x", LINE.format("ABBT0").replace(",20,", ",99,")])          # corrected
    res = ingest.load_battery_files(bronze, [a, b], skip_loaded_files=True)
    assert res["rows_loaded"] == 1 and len(res["files_skipped"]) == 1
    from plumeline.operators.medallion import battery_fact
    latest = {r.facility_id: r.gas_prod_1000m3 for r in battery_fact(bronze.table(TABLE_FACILITIES)).collect()}
    assert latest == {"ABBT0": 99.0, "ABBT1": 20.0}


@pytest.mark.parametrize("step", ["rejects", "publish"])
def test_a_load_that_dies_is_taken_back_by_its_retry(bronze, scratch, monkeypatch, step):
    p = _write(scratch, "ST60_2024-03.csv", [LINE.format("ABBT1"), "ABBT2,F,O,T,d,junk,1,1,1,1,1,1"])
    other = _write(scratch, "ST60_2024-04.csv", [LINE.format("ABBT3")])
    ingest.load_battery_files(bronze, other, skip_loaded_files=True)
    real_write = ledger.write_load

    def write(df, table):
        if step == "rejects" and table == ledger.REJECTS:
            raise KeyboardInterrupt
        real_write(df, table)
        if step == "publish" and table == TABLE_FACILITIES:
            raise KeyboardInterrupt

    monkeypatch.setattr(ledger, "write_load", write)
    with pytest.raises(KeyboardInterrupt):
        ingest.load_battery_files(bronze, p, skip_loaded_files=True)
    monkeypatch.undo()
    assert {r.facility_id for r in ledger.committed(bronze, TABLE_FACILITIES).collect()} == {"ABBT3"}
    res = ingest.load_battery_files(bronze, p, skip_loaded_files=True)
    assert res["rows_loaded"] == 1 and res["rows_rejected"] == {"location_not_resolved": 1}
    assert sorted(r.facility_id for r in bronze.table(TABLE_FACILITIES).collect()) == ["ABBT1", "ABBT3"]
    assert bronze.table(ledger.REJECTS).where("target = 'bronze.aer_battery_monthly'").where(F.col("source_path").contains(scratch)).count() == 1
    states = {(r.load_no, r.status) for r in ledger.load_states(bronze, TABLE_FACILITIES).where(F.col("path").contains(os.path.basename(p))
                                                                                                & F.col("path").contains(scratch)).collect()}
    assert {s for _, s in states} == {"rolled_back", "committed"}


def test_a_batch_that_fails_its_gates_never_shows_up(bronze, scratch):
    nothing = _write(scratch, "ST60_2024-05.csv", ["ABBT2,F,O,T,d,junk,1,1,1,1,1,1"])
    with pytest.raises(ledger.LoadFailed) as e:
        ingest.load_battery_files(bronze, nothing, gate=True)
    assert e.value.checks == ["row_count"] and bronze.table(TABLE_FACILITIES).count() == 0
    audits = bronze.table(ledger.AUDITS).where(F.col("load_no") == e.value.load_no).collect()
    assert {r.check: r.status for r in audits}["row_count"] == "FAILED" and len(audits) == 4
    assert bronze.table(ledger.staging_name(TABLE_FACILITIES)).where(F.col("load_no") == e.value.load_no).count() == 0
    good = ingest.load_granules(bronze, granules(bronze, [("g.nc", 0, [0, 1], 2)]), gate=True)
    assert good["rows_loaded"] == 4 == bronze.table(TABLE_PIXELS).count()


def test_id_blocks_never_overlap(spark, scratch):
    got = []

    def claim():
        for n in (3, 1, 5):
            got.append((ledger.allocate(spark, "seq", n, home=scratch), n))

    threads = [threading.Thread(target=claim) for _ in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(x for first, n in got for x in range(first, first + n)) == list(range(1, 4 * 9 + 1))
    assert ledger.high_water(spark, "seq", home=scratch) == 36 and ledger.high_water(spark, "other", home=scratch) == 0


def files_of(spark, table):
    root = ledger.table_location(spark, table).removeprefix("file:")
    return {os.path.relpath(os.path.join(d, f), root): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_retention_drops_days_and_ids_do_not_come_again(bronze):
    from plumeline.operators.medallion import write_silver

    # Day 0 is out, day 1 is cut in two (its early pixels go), days 5 to 11 stay: a window of 10 days before day 11, noon.
    early = granules(bronze, [("old.nc", 0, [0, 1, 5], 2)])
    shifted = F.transform("swath", lambda line: F.transform(line, lambda p: p.withField("time", (p["time"] - F.make_dt_interval(hours=F.lit(3))).cast("timestamp_ntz"))))
    ingest.load_granules(bronze, early.unionByName(granules(bronze, [("cut.nc", 0, [1], 2)]).withColumn("swath", shifted.cast(GRANULE_SCHEMA["swath"].dataType))))
    ingest.load_granules(bronze, granules(bronze, [("new.nc", 0, [5, 11], 2)]))
    write_silver(bronze)
    before_ids = {r.row_id for r in bronze.table(TABLE_PIXELS).collect()}
    assert before_ids == set(range(1, 13))
    want = sorted(r.row_id for r in retention.retained(bronze.table(TABLE_PIXELS), 10).collect())
    before = files_of(bronze, TABLE_PIXELS)
    out = retention.apply_retention(bronze, days=10)
    assert [(o["dropped_folders"], o["rewritten_folders"]) for o in out] == [(1, 1), (1, 1)]
    assert sorted(r.row_id for r in bronze.table(TABLE_PIXELS).collect()) == want and len(want) == 8
    assert sorted(r.row_id for r in bronze.table("silver.sentinel5p_ch4_cleaned").collect()) == want
    after = files_of(bronze, TABLE_PIXELS)
    untouched = {f for f in before if "2024-01-01" not in f and "2024-01-02" not in f}
    assert len(untouched) == 3 and all(after.get(f) == before[f] for f in untouched)
    assert retention.apply_retention(bronze, days=10)[0] == {"table": TABLE_PIXELS, "dropped_folders": 0, "rewritten_folders": 0}
    res = ingest.load_granules(bronze, granules(bronze, [("later.nc", 0, [12], 2)]))
    ids = [r.row_id for r in bronze.table(TABLE_PIXELS).collect()]
    assert res["rows_loaded"] == 2 and len(set(ids)) == len(ids) and {13, 14} <= set(ids)


def test_refresh_rewrites_the_days_of_new_loads_only(bronze):
    from plumeline.operators import medallion as M
    from plumeline.sources import refresh

    def full():
        pix = bronze.table(TABLE_PIXELS)
        return [sorted(map(str, df.select(*sorted(df.columns)).collect())) for df in
                (M.silver_pixels(pix), M.ch4_hotspots(pix, 5))]

    def now():
        tables_ = (bronze.table("silver.sentinel5p_ch4_cleaned").drop("day"), bronze.table("gold.regional_ch4_hotspots"))
        return [sorted(map(str, df.select(*sorted(df.columns)).collect())) for df in tables_]

    for name in ("silver.sentinel5p_ch4_cleaned", "gold.regional_ch4_hotspots", refresh.CELL_DAYS, refresh.MARKS):
        bronze.sql(f"DROP TABLE IF EXISTS {name}")
    ingest.load_granules(bronze, granules(bronze, [("a.nc", 0, [0, 1], 12), ("b.nc", 0, [1, 2], 12)]))
    assert refresh.refresh_silver(bronze)["days"] == ["2024-01-01", "2024-01-02", "2024-01-03"]
    refresh.refresh_hotspots(bronze)
    assert now() == full()
    before = {**files_of(bronze, "silver.sentinel5p_ch4_cleaned"), **files_of(bronze, refresh.CELL_DAYS)}
    # A new file on a new day, and the same pixels of b.nc once more, now also measured on that day.
    ingest.load_granules(bronze, granules(bronze, [("c.nc", 0, [5], 12), ("b.nc", 0, [5, 2], 14)]))
    assert refresh.refresh_silver(bronze)["days"] == ["2024-01-02", "2024-01-03", "2024-01-06"]
    assert refresh.refresh_hotspots(bronze)["days"] == ["2024-01-01", "2024-01-03", "2024-01-06"]
    assert now() == full() and len(now()[1]) > 0
    after = {**files_of(bronze, "silver.sentinel5p_ch4_cleaned"), **files_of(bronze, refresh.CELL_DAYS)}
    assert {f for f in before if after.get(f) == before[f]} == {f for f in before if f in after} != set()
    assert refresh.refresh_silver(bronze)["days"] == []
    assert now() == full()


def test_writes_are_zstd_clustered_and_split_hot_days(bronze, scratch):
    import pyarrow.parquet as pq

    one = granules(bronze, [(f"f{i}.nc", 64 * i, [0, 1, 2], 20) for i in range(6)]).repartition(6)
    ingest.load_granules(bronze, one)
    root = ledger.table_location(bronze, TABLE_PIXELS).removeprefix("file:")
    found = sorted(files_of(bronze, TABLE_PIXELS))
    assert len(found) == 3                                     # one file a day, not one for each task and day
    assert {pq.ParquetFile(os.path.join(root, f)).metadata.row_group(0).column(2).compression for f in found} == {"ZSTD"}
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = bronze.conf.get(key)
    bronze.conf.set(key, "64k")
    try:
        hot = bronze.range(0, 200_000, 1, 8).select("id", F.when(F.col("id") % 50 == 0, "b").otherwise("a").alias("day"), F.rand(1).alias("x"))
        tables.write_parquet(hot, os.path.join(scratch, "hot"), ["day"])
    finally:
        bronze.conf.set(key, old)
    parts = {d: sum(f.endswith(".parquet") for f in os.listdir(os.path.join(scratch, "hot", d))) for d in ("day=a", "day=b")}
    assert parts["day=a"] > 4 and parts["day=b"] <= 2


def test_records_over_lines_and_splits_equal_a_csv_parser(spark, scratch):
    rng = random.Random(5)
    long_field = "\n".join(f"line {i}, with 12\" and a comma" for i in range(60))          # longer than a split
    rows = []
    for i in range(300):
        op = rng.choice(["OP A", "A, B\nand \"C\"", 'say ""', "\n\n", "x\n", '"', "a\n,\"\n,b", f"12{chr(34)} pipe", "plain"])
        rows.append([f"ABBT{i:05d}", "F", long_field if i == 150 else op, "T", "d", "02-21-065-04W4", "1", str(i), "1", "1", "1", "1"])
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    text = out.getvalue().replace('"12"" pipe"', '12" pipe')                                # a plain quote inside a field
    path = _write(scratch, "ST60_2024_08.csv", text.rstrip("\n").split("\n"))
    body = open(path).read().split("\n", 3)[3]
    want = [(r[0], r[2].strip() or None, float(r[7])) for r in csv.reader(io.StringIO(body))]
    assert len(want) == 300
    plain = _write(scratch, "ST60_2024_09.csv", [LINE.format("ABBTP")])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        got = battery_csv.read_battery_csv(spark, [path, plain]).orderBy("source_file", "_line_block", "_line_pos").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    strip = lambda x: x.strip(" ") or None
    assert [(r.facility_id, r.gas_prod_1000m3) for r in got] == [(w[0], w[2]) for w in want] + [("ABBTP", 20.0)]
    raw = [strip(r[2]) for r in csv.reader(io.StringIO(body))]
    assert [r.operator for r in got[:300]] == raw


def test_a_quote_that_never_closes_rejects_its_record_only(spark, scratch):
    rows = [LINE.format("ABBT1"), 'ABBT2,F,"a\nb",T,d,02-21-065-04W4,1,2,1,1,1,1', 'ABBT3,F,"open,T,d,02-21-065-04W4,1,2,1,1,1,1'] + [LINE.format("ABBT9")] * 40
    path = _write(scratch, "ST60_2024_10.csv", rows)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        good, rejects = ingest.battery_rows(spark, [path])
        assert sorted(r.facility_id for r in good.collect()) == ["ABBT1", "ABBT2"]
        assert [(r.reason, r.bty_location_raw[:5]) for r in rejects.collect()] == [("unclosed_quote", "ABBT3")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.mark.parametrize("name", ["append_row_ids", "file_row_numbers", "pixel_coverage"])
def test_sources_are_scanned_at_most_twice_and_not_expanded(spark, name):
    from plumeline.plans.catalog import QUERIES

    plan = _final_plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert "Expand" not in plan
    assert 1 <= plan.count("FileScan parquet") <= (1 if name == "pixel_coverage" else 2), plan


def test_swath_files_do_not_stop_each_other(spark, scratch):
    folder = os.path.join(scratch, "mixed")
    spark.createDataFrame([(1, "x.nc")], "orbit_attr int, file_path string").coalesce(1).write.parquet(folder)
    granules(spark, [("good.nc", 0, [0], 2)]).coalesce(1).write.mode("append").parquet(folder)
    assert swath.flatten_swath(swath.read_granules(spark, folder)).count() == 2
