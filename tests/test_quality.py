"""Gate statuses and aggregate edge cases on hand-made frames."""

import datetime as dt

import pytest

from plumeline.model import FACILITY_SCHEMA, PIXEL_SCHEMA
from plumeline.operators import aggregates as A
from plumeline.operators import quality as Q
from plumeline.sources.tables import conform, empty_like

TS = dt.datetime(2024, 7, 14, 18, 0)


def _pix(spark, rows):
    """rows: (row_id, lat, lon, ch4, qa, orbit, file, scanline, gp)"""
    df = spark.createDataFrame(
        [(r[0], TS, r[3], r[4], r[1], r[2], r[5], r[6], r[7], r[8]) for r in rows],
        "row_id long, measurement_timestamp timestamp_ntz, ch4_column double, qa_value double, latitude double, "
        "longitude double, orbit_number int, file_path string, scanline long, ground_pixel long")
    return conform(df, PIXEL_SCHEMA)


def _fac(spark, rows):
    """rows: (row_id, facility_id, operator, month, lat, lon, prod, flared, vented)"""
    df = spark.createDataFrame(
        [(r[0], r[1], r[2], r[3], r[4], r[5], r[6], r[7], r[8]) for r in rows],
        "row_id long, facility_id string, operator string, reporting_month date, latitude double, longitude double, "
        "gas_prod_1000m3 double, gas_flared_1000m3 double, gas_vented_1000m3 double")
    return conform(df, FACILITY_SCHEMA)


def _status(df):
    return {r.check: (r.value, r.status) for r in df.collect()}


def test_pixel_gates_on_empty_table(spark):
    pix = empty_like(spark, PIXEL_SCHEMA)
    fac = empty_like(spark, FACILITY_SCHEMA)
    got = _status(Q.audit_pixels(pix, fac))
    assert got["row_count"] == (0.0, "FAILED")
    assert got["orbit_coverage"] == (0.0, "WARNING")
    assert got["extent_in_bbox"][1] == "WARNING"
    assert got["facility_overlap"] == (0.0, "WARNING")


def test_pixel_gates_pass_and_warn(spark):
    rows = [(i, 51.0 + i * 1e-3, -114.0, 1800.0, 0.9, 36000 + i % 3, "f", i, 0) for i in range(20)]
    rows.append((19, 61.0, -114.0, 2200.0, 0.05, 36000, "f", 99, 0))          # duplicate id, outside bbox
    fac = _fac(spark, [(1, "A", "OP", dt.date(2024, 7, 1), 51.0, -114.0, 1.0, 0.0, 0.0)])
    got = _status(Q.audit_pixels(_pix(spark, rows), fac))
    assert got["row_count"] == (21.0, "WARNING")                 # under 1000 rows
    assert got["orbit_coverage"] == (3.0, "PASSED")
    assert got["extent_in_bbox"] == (0.0, "WARNING")
    assert got["mean_qa"][1] == "PASSED"
    assert got["mean_ch4"][1] == "PASSED"
    assert got["missing_location"] == (0.0, "PASSED")
    assert got["facility_overlap"][1] == "PASSED"
    assert got["duplicate_row_ids"] == (1.0, "WARNING")


def test_facility_gates(spark):
    fac = _fac(spark, [(1, "A", "OP", dt.date(2024, 7, 1), 51.0447, -114.0719, 1.0, 0.0, 0.0),
                       (2, "B", "OP", dt.date(2024, 7, 1), 60.5, -114.0, 1.0, 0.0, 0.0),
                       (3, "C", "OP", dt.date(2024, 7, 1), None, None, 1.0, 0.0, 0.0)])
    got = _status(Q.audit_facilities(fac))
    assert got["row_count"] == (3.0, "PASSED")
    assert got["latitude_in_bbox"] == (0.0, "WARNING")
    assert got["missing_location"] == (1.0, "WARNING")
    assert got["facilities_near_city"] == (1.0, "INFO")
    assert _status(Q.audit_facilities(empty_like(spark, FACILITY_SCHEMA)))["row_count"] == (0.0, "WARNING")


def test_monthly_production_nulls_and_zero_production(spark):
    m1, m2 = dt.date(2024, 6, 1), dt.date(2024, 7, 1)
    fac = _fac(spark, [
        (1, "A", "OP", m1, 51.0, -114.0, 10.0, 1.0, 0.5),
        (2, "B", "OP", m1, 51.0, -114.0, 6.0, None, 2.0),     # flared NULL: row skipped in sum(flared + vented)
        (3, "C", "OP", m1, 51.0, -114.0, 0.0, 5.0, 5.0),      # no production: filtered out
        (4, "D", "OP", m2, 51.0, -114.0, None, 1.0, 1.0),     # NULL production: filtered out
    ])
    rows = A.monthly_production(fac).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.num_facilities, r.total_gas_prod_1000m3, r.total_gas_flared_1000m3, r.total_gas_vented_1000m3) == \
        (2, 16.0, 1.0, 2.5)
    assert r.pct_emissions == round(1.5 / 16.0 * 100 * 100) / 100


def test_ch4_histogram_equal_bounds_and_last_bin(spark):
    same = _pix(spark, [(i, 51.0, -114.0, 1800.0, 0.9, 1, "f", i, 0) for i in range(3)])
    rows = A.ch4_histogram(same).collect()
    assert len(rows) == 50 and sum(r.pixel_count for r in rows) == 3
    hit = [r for r in rows if r.pixel_count]
    assert len(hit) == 1 and hit[0].bin_lo <= 1800.0 < hit[0].bin_hi        # bounds widened to +-0.5

    spread = _pix(spark, [(i, 51.0, -114.0, v, 0.9, 1, "f", i, 0)
                          for i, v in enumerate([1700.0, 1750.0, 2100.0, 1699.0, 2101.0, None])])
    rows = A.ch4_histogram(spread).collect()
    counts = {r.bin: r.pixel_count for r in rows}
    assert counts[1] == 1 and counts[50] == 1 and sum(counts.values()) == 3  # max value in the last bin
    assert rows[0].mean_ch4 == pytest.approx((1700 + 1750 + 2100) / 3)


def test_top_operators_tie_break_and_nulls(spark):
    fac = _fac(spark, [(i, str(i), op, dt.date(2024, 7, 1), 51.0, -114.0, 1.0, 0.0, 0.0)
                       for i, op in enumerate(["B", "A", "C", "A", "B", None, None, None])])
    got = [(r.operator, r.facility_count) for r in A.top_operators(fac, k=2).collect()]
    assert got == [("A", 2), ("B", 2)]


def test_grid_means(spark):
    pix = _pix(spark, [(0, 51.024, -114.026, 1800.0, 0.9, 1, "f", 0, 0), (1, 51.026, -114.024, 1900.0, 0.9, 1, "f", 0, 1),
                       (2, 51.03, -114.03, 2000.0, 0.2, 1, "f", 0, 2)])
    g05 = {(r.lat_grid, r.lon_grid): r.avg_ch4 for r in A.grid_mean_snap(pix).collect()}
    assert sum(1 for _ in g05) == 2                                # low-QA pixel excluded, two cells
    g1 = A.grid_mean_round(pix).collect()
    assert len(g1) == 1 and g1[0].avg_ch4 == 1850.0 and g1[0].n_pixels == 2
