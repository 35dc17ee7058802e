"""Row filters (F1-F6). Plain comparisons, so Catalyst pushes them into the Parquet scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumeline.model import BBOX, CH4_MAX_VALID, CH4_MIN_VALID, QA_BRONZE


def in_bbox(df: DataFrame, lat: str = "latitude", lon: str = "longitude", bbox: dict = BBOX) -> DataFrame:
    """inclusive on every side."""
    return df.where(F.col(lat).between(bbox["min_lat"], bbox["max_lat"])
                    & F.col(lon).between(bbox["min_lon"], bbox["max_lon"]))


def valid_swath_pixels(df: DataFrame, qa_min: float = QA_BRONZE) -> DataFrame:
    """F2 on flattened swath rows: ch4 / lat / lon present, qa >= threshold, then no missing value
    in any pixel column. NaN must already be NULL (``nan_to_null``)."""
    return (df.where(F.col("ch4").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull()
                     & (F.col("qa") >= F.lit(qa_min)))
            .dropna(subset=["time", "lat", "lon", "ch4", "qa", "scanline", "ground_pixel"]))


def valid_pixels(df: DataFrame, qa_min: float = QA_BRONZE) -> DataFrame:
    """F2 on rows already in the bronze column names."""
    return (df.where(F.col("ch4_column").isNotNull() & F.col("latitude").isNotNull()
                     & F.col("longitude").isNotNull() & (F.col("qa_value") >= F.lit(qa_min)))
            .dropna(subset=["measurement_timestamp", "latitude", "longitude", "ch4_column",
                            "qa_value", "scanline", "ground_pixel"]))


def qa_at_least(df: DataFrame, threshold: float, col: str = "qa_value") -> DataFrame:
    """F3."""
    return df.where(F.col(col) >= F.lit(threshold))


def ch4_in_range(df: DataFrame, col: str = "ch4_column", lo: float = CH4_MIN_VALID,
                 hi: float = CH4_MAX_VALID) -> DataFrame:
    """``BETWEEN lo AND hi``."""
    return df.where(F.col(col).between(lo, hi))


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    """F5."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def positive_production(df: DataFrame, col: str = "gas_prod_1000m3") -> DataFrame:
    """F6."""
    return df.where(F.col(col) > F.lit(0))
