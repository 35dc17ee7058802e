"""Distance search and distance joins on (latitude, longitude) points.

The joins never compare every pair. Each right point is exploded into the grid cells its
``radius`` disc can touch (latitude and per-row longitude reach), the left point falls into exactly
one cell, and the equi-join on the cell carries the exact haversine test as a residual. The
plan is a hash join (broadcast when AQE finds one side small), never a nested loop. Pairs are
met at most once, so an inner join needs no dedupe.

The cell side follows the radius (at least ``GRID_DEG``), so a disc touches a handful of cells at any
radius, more only where meridians converge. Longitude cells divide the full circle evenly and wrap at
+-180 degrees; a disc that reaches a pole spans every longitude cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumeline.functions.geo import (cell_index, haversine_m, lat_reach_deg, lon_reach_deg,
                                     lon_reach_deg_scalar)
from plumeline.model import GRID_DEG

_EPS_DEG = 1e-9
_NO_CELL = -(2 ** 62)   # never produced by a real coordinate


def _grid(radius_m: float, cell_deg: float | None) -> tuple[float, int]:
    """(latitude cell side in degrees, number of longitude cells on the full circle)."""
    side = cell_deg or max(GRID_DEG, lat_reach_deg(radius_m))
    return side, max(int(360.0 // side), 1)


def _lon_cell(lon, n_lon: int):
    """Unwrapped longitude cell; ``pmod`` with the number of cells closes the circle."""
    return F.floor((lon + F.lit(180.0)) * F.lit(n_lon / 360.0)).cast("long")


def _cells_of_point(lat: str, lon: str, side: float, n_lon: int):
    # Non-null keys: a row without coordinates gets a cell no right point has (it could not pass
    # the distance test anyway), so Catalyst infers no null filter beneath the left input and two
    # uses of the same left input remain one shared plan.
    return (F.coalesce(cell_index(F.col(lat), side), F.lit(_NO_CELL)).alias("_ci"),
            F.coalesce(F.pmod(_lon_cell(F.col(lon), n_lon), F.lit(n_lon)), F.lit(_NO_CELL)).alias("_cj"))


def explode_reach_cells(df: DataFrame, lat: str, lon: str, radius_m: float, cell_deg: float | None = None) -> DataFrame:
    """Add ``_ci, _cj``: one row per grid cell within ``radius_m`` of the point."""
    side, n_lon = _grid(radius_m, cell_deg)
    dlat = lat_reach_deg(radius_m) + _EPS_DEG
    dlon = lon_reach_deg(F.col(lat), radius_m) + F.lit(_EPS_DEG)
    lat_lo = cell_index(F.greatest(F.col(lat) - F.lit(dlat), F.lit(-90.0)), side)
    lat_hi = cell_index(F.least(F.col(lat) + F.lit(dlat), F.lit(90.0)), side)
    # A cap over a pole reaches every longitude (and so does a radius beyond a quarter of the globe).
    over_pole = (F.abs(F.col(lat)) + F.lit(dlat) >= F.lit(90.0)) | F.lit(dlat >= 90.0)
    lon_lo, lon_hi = _lon_cell(F.col(lon) - dlon, n_lon), _lon_cell(F.col(lon) + dlon, n_lon)
    all_lon = over_pole | (lon_hi - lon_lo >= F.lit(n_lon - 1))
    cells = F.when(all_lon, F.sequence(F.lit(0).cast("long"), F.lit(n_lon - 1).cast("long"))).otherwise(F.sequence(lon_lo, lon_hi))
    return (df.withColumn("_ci", F.explode(F.sequence(lat_lo, lat_hi)))
              .withColumn("_cj", F.explode(cells)).withColumn("_cj", F.pmod("_cj", F.lit(n_lon))))


def _prep(left: DataFrame, right: DataFrame, radius_m: float, left_lat: str, left_lon: str,
          right_lat: str, right_lon: str, cell_deg: float | None):
    if radius_m <= 0:
        raise ValueError("radius_m must be positive")
    r = right.where(F.col(right_lat).isNotNull() & F.col(right_lon).isNotNull())
    r = r.select([F.col(c).alias("_r_" + c) for c in right.columns])
    r = explode_reach_cells(r, "_r_" + right_lat, "_r_" + right_lon, radius_m, cell_deg)
    l_cells = left.select("*", *_cells_of_point(left_lat, left_lon, *_grid(radius_m, cell_deg)))
    cond = ((l_cells["_ci"] == r["_ci"]) & (l_cells["_cj"] == r["_cj"])
            & (haversine_m(l_cells[left_lat], l_cells[left_lon], r["_r_" + right_lat], r["_r_" + right_lon])
               <= F.lit(float(radius_m))))
    return l_cells, r, cond


def distance_semi_join(left: DataFrame, right: DataFrame, radius_m: float,
                       left_lat: str = "latitude", left_lon: str = "longitude",
                       right_lat: str = "latitude", right_lon: str = "longitude",
                       cell_deg: float | None = None) -> DataFrame:
    """Rows of ``left`` with at least one ``right`` point within ``radius_m`` (EXISTS)."""
    right_pts = right.select(right_lat, right_lon).dropna().distinct()
    l_cells, r, cond = _prep(left, right_pts, radius_m, left_lat, left_lon, right_lat, right_lon, cell_deg)
    return l_cells.join(r, cond, "left_semi").drop("_ci", "_cj")


def distance_inner_join(left: DataFrame, right: DataFrame, radius_m: float,
                        left_lat: str = "latitude", left_lon: str = "longitude",
                        right_lat: str = "latitude", right_lon: str = "longitude",
                        cell_deg: float | None = None, distance_col: str = "distance_m",
                        right_prefix: str = "r_") -> DataFrame:
    """Every (left, right) pair within ``radius_m``, with the distance. Right columns get
    ``right_prefix``. Callers should pre-aggregate/dedupe each side first."""
    l_cells, r, cond = _prep(left, right, radius_m, left_lat, left_lon, right_lat, right_lon, cell_deg)
    joined = l_cells.join(r, cond, "inner")
    dist = haversine_m(l_cells[left_lat], l_cells[left_lon], r["_r_" + right_lat], r["_r_" + right_lon])
    out_cols = [l_cells[c] for c in left.columns]
    out_cols += [r["_r_" + c].alias(right_prefix + c) for c in right.columns]
    return joined.select(*out_cols, dist.alias(distance_col))


def within_radius(df: DataFrame, lat0: float, lon0: float, radius_m: float,
                  lat: str = "latitude", lon: str = "longitude",
                  distance_col: str = "distance_m") -> DataFrame:
    """Rows within ``radius_m`` of one point, with the distance. A bounding box that
    contains the disc is applied first as plain comparisons (pushed into the scan)."""
    dlat = lat_reach_deg(radius_m) + _EPS_DEG
    dlon = lon_reach_deg_scalar(lat0, radius_m) + _EPS_DEG
    box = F.col(lat).between(lat0 - dlat, lat0 + dlat)
    if abs(lat0) + dlat < 90.0 and dlon < 180.0:                 # otherwise the disc spans every longitude
        sides = F.col(lon).between(lon0 - dlon, lon0 + dlon)
        if lon0 - dlon < -180.0:
            sides = sides | (F.col(lon) >= lon0 - dlon + 360.0)
        if lon0 + dlon > 180.0:
            sides = sides | (F.col(lon) <= lon0 + dlon - 360.0)
        box = box & sides
    boxed = df.where(box)
    dist = haversine_m(F.col(lat), F.col(lon), F.lit(float(lat0)), F.lit(float(lon0)))
    return boxed.withColumn(distance_col, dist).where(F.col(distance_col) <= F.lit(float(radius_m)))
