"""Tags carried in file names: reporting month of a battery CSV, orbit number of a granule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumeline.model import ORBIT_IN_NAME_RE, REPORT_MONTH_RE


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_from_name(name) -> Column:
    """First day of the ``YYYY[_-]MM`` month in a file name; NULL when absent or not a month."""
    y = F.regexp_extract(_c(name), REPORT_MONTH_RE, 1)
    m = F.regexp_extract(_c(name), REPORT_MONTH_RE, 2)
    yi, mi = y.try_cast("int"), m.try_cast("int")
    return F.when(mi.between(1, 12) & (yi >= 1), F.make_date(yi, mi, F.lit(1)))


def orbit_from_name(name, fallback=None) -> Column:
    """Orbit number after the two timestamps of a granule name, else ``fallback`` (the granule's
    own attribute)."""
    tag = F.regexp_extract(_c(name), ORBIT_IN_NAME_RE, 3)
    from_name = F.when(tag != "", tag.cast("int"))
    if fallback is None:
        return from_name
    return F.coalesce(from_name, _c(fallback).cast("int"))
