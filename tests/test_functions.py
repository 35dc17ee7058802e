"""Column expressions on hand-made rows (X1-X7, P2, Q-cases)."""

import math

import pytest

from tests.oracle_compare import duck_geocode

from plumeline.functions import (grid_snap, haversine_m, lenient_double, lenient_int, month_from_name,
                                 orbit_from_name, round_n)
from plumeline.functions.location import geocode, with_location


CASES = [
    ("02-21-065-04W4", (2, 21, 65, 4, "W", 4)),
    (" 02-21-065-04w4 ", (2, 21, 65, 4, "W", 4)),
    ("16-36-126-34W6", (16, 36, 126, 34, "W", 6)),
    ("1-1-1-1E5", (1, 1, 1, 1, "E", 5)),
    ("0654042102", (2, 21, 54, 4, "W", 6)),        # as written: MM TT RR SS LL
    ("0465040102", (2, 1, 65, 4, "W", 4)),
]
NULL_CASES = ["", "nan", "NAN", "UNKNOWN", None, "17-01-001-01W4", "01-37-001-01W4", "01-01-127-01W4",
              "01-01-001-35W4", "01-01-001-01W7", "01-01-001-01X4", "0765040102", "12345"]


def _as_columns(df, raw):
    xy = df.withColumn("xy", geocode(raw))
    return xy.select("i", "xy.latitude", "xy.longitude")


@pytest.mark.parametrize("staged", [True, False])
def test_geocode_as_written(spark, staged):
    texts = [c[0] for c in CASES] + NULL_CASES
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, loc string")
    fn = with_location if staged else _as_columns
    got = {r.i: (r.latitude, r.longitude) for r in fn(df, "loc").collect()}
    want = duck_geocode(texts)                      # the oracle's SQL statement, in DuckDB
    for i in range(len(CASES)):
        assert want[i][0] is not None, texts[i]
        assert got[i][0] == pytest.approx(want[i][0], abs=1e-6) and got[i][1] == pytest.approx(want[i][1], abs=1e-6)
    for j in range(len(CASES), len(texts)):
        assert got[j] == (None, None) and want[j] == (None, None), texts[j]
    # Same place from the dashed and the padded / lower-case forms.
    assert got[0] == got[1]


def test_geocode_corrected_reads_compact_3_1_2_2_2(spark):
    # The two documented examples name the same place only when the compact code is read
    # township(3) meridian(1) range(2) section(2) lsd(2).
    df = spark.createDataFrame([(0, "02-21-065-04W4"), (1, "0654042102")], "i int, loc string")
    got = {r.i: (r.latitude, r.longitude) for r in with_location(df, "loc", "corrected").collect()}
    assert got[0] == got[1]
    want = duck_geocode(["02-21-065-04W4"], "corrected")[0]
    assert got[0][0] == pytest.approx(want[0], abs=1e-6) and got[0][1] == pytest.approx(want[1], abs=1e-6)
    # Township and range count from 1 in the corrected reading: one township further south-east.
    as_written = duck_geocode(["02-21-065-04W4"])[0]
    assert as_written[0] - got[0][0] == pytest.approx(6 * 1609.344 / 111320, abs=1e-5)


def test_geocode_located_only_drops_unresolved(spark):
    df = spark.createDataFrame([(0, "02-21-065-04W4"), (1, "junk"), (2, None), (3, "02-21-065-04W4")],
                               "i int, loc string")
    assert sorted(r.i for r in with_location(df, "loc", located_only=True).collect()) == [0, 3]


def test_round_n_half_away_on_scaled_value(spark):
    df = spark.createDataFrame([(2.675,), (1.005,), (-2.5,), (0.125,), (None,)], "x double")
    got = [r[0] for r in df.select(round_n("x", 2)).collect()]
    assert got[:4] == [round(2.675 * 100) / 100, round(1.005 * 100) / 100, -2.5, 0.13]
    assert got[4] is None
    assert [r[0] for r in df.select(round_n("x", 0)).collect()][:3] == [3.0, 1.0, -3.0]


def test_grid_snap_half_even(spark):
    df = spark.createDataFrame([(0.125,), (0.075,), (51.025,)], "x double")
    got = [r[0] for r in df.select(grid_snap("x", 0.05)).collect()]
    assert got == [round(0.125 / 0.05) * 0.05, round(0.075 / 0.05) * 0.05, round(51.025 / 0.05) * 0.05]


def test_lenient_numbers(spark):
    texts = ["12", " 12 ", "1e3", "1,234", "12d", "", "n/a", "inf", "-3.5", ".5", "nan", None, "3.0"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r) for r in df.select(lenient_double("t"), lenient_int("t")).collect()]
    assert got == [(12.0, 12), (12.0, 12), (1000.0, 1000), (None, None), (None, None), (None, None),
                   (None, None), (float("inf"), None), (-3.5, None), (0.5, None), (None, None),
                   (None, None), (3.0, 3)]


def test_month_and_orbit_from_names(spark):
    df = spark.createDataFrame([
        ("ST60_2024_06.csv", "S5P_OFFL_L2__CH4____20250714T183522_20250714T201652_36033_03_X.nc", 1),
        ("ST60_2025-01.csv", "granule.nc", 36100),
        ("ST60_2025_13.csv", "granule.nc", None),
        ("facilities.csv", "x_20250714T183522_20250714T201652_1234_.nc", 7)], "f string, g string, a int")
    rows = df.select(month_from_name("f").alias("m"), orbit_from_name("g", "a").alias("o")).collect()
    assert [str(r.m) if r.m else None for r in rows] == ["2024-06-01", "2025-01-01", None, None]
    assert [r.o for r in rows] == [36033, 36100, None, 7]


def test_haversine_known_distance(spark):
    # One degree of latitude on a 6,371 km sphere.
    df = spark.createDataFrame([(51.0, -114.0, 52.0, -114.0), (51.0447, -114.0719, 51.0447, -114.0719)],
                               "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_m("a", "b", "c", "d")).collect()]
    assert got[0] == pytest.approx(6371000 * math.pi / 180, rel=1e-12)
    assert got[1] == 0.0


def test_nan_is_missing_before_filters(spark):
    from plumeline.plans.fixtures import bronze_pixels
    df = spark.sql("""select 1L as row_id, timestamp_ntz'2024-01-01 00:00:00' as measurement_timestamp,
                     cast('NaN' as double) as ch4_column, 0.9D as qa_value, 50.0D as latitude,
                     -115.0D as longitude, 1 as scanline, 1 as ground_pixel
                   union all select 2L, timestamp_ntz'2024-01-01 00:00:00', 1800.0D, cast('NaN' as double),
                     50.0D, -115.0D, 1, 2""")
    assert bronze_pixels(df).count() == 0
