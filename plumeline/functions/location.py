"""Legal survey location text -> (lsd, section, township, range, direction, meridian) -> lat/lon.

Two text forms are read: dashed ``LSD-SEC-TWP-RGE{W|E}MER`` and a 10-digit compact code. The
position arithmetic follows the published approximation; ``mode="corrected"`` fixes three of its
defects (compact field order, township/range counted from 1, serpentine LSD numbering).

The expressions are written as Spark SQL text and handed over once with ``F.expr``: built from
``pyspark.sql.functions`` they take thousands of driver-to-JVM calls. Intermediate values are
bound once with ``transform(array(value), x -> body)[0]``, so optimizer rewrites that substitute
expressions (predicate pushdown, projection collapsing) copy each value once, not per use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumeline.model import (COMPACT_LOCATION_RE, DASHED_LOCATION_RE, DEG2RAD, MERIDIAN_BASE_LON,
                             METERS_PER_DEG_LAT, MILE_M, SURVEY_BASE_LAT)

MODES = ("as_written", "corrected")
TOWNSHIP_M = 6 * MILE_M
SECTION_M = 1 * MILE_M
LSD_M = SECTION_M / 4


def _d(x: float) -> str:
    """Double literal (a bare decimal is DECIMAL in Spark SQL and would change the arithmetic)."""
    return repr(float(x)) + "D"


def _s(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(value: str, var: str, body: str) -> str:
    return f"transform(array({value}), {var} -> {body})[0]"


def _ref(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


#: All Unicode white space, which a text's ends are stripped of.
WHITE_SPACE = "".join(chr(c) for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                       0x2028, 0x2029, 0x202F, 0x205F, 0x3000))


def normalized_sql(raw_sql: str) -> str:
    """Upper-case text without white space at its ends; '' and 'NAN' are missing."""
    return f"nullif(nullif(upper(btrim(cast({raw_sql} as string), {_s(WHITE_SPACE)})), ''), 'NAN')"


def _check(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")


def _field_sqls(v: str, d: str, c: str, mode: str) -> dict[str, str]:
    """Each location field from the text ``v`` and the tests for the dashed (d) and compact (c) form."""
    dashed = _s(DASHED_LOCATION_RE)
    if mode == "as_written":   # meridian, township, range, section, lsd: 2 digits each
        pos = {"mer": (1, 2), "twp": (3, 2), "rng": (5, 2), "sec": (7, 2), "lsd": (9, 2)}
    else:                      # township(3) meridian(1) range(2) section(2) lsd(2)
        pos = {"twp": (1, 3), "mer": (4, 1), "rng": (5, 2), "sec": (7, 2), "lsd": (9, 2)}
    group = {"lsd": 1, "sec": 2, "twp": 3, "rng": 4, "mer": 6}
    out = {k: f"CAST(CASE WHEN {d} THEN regexp_extract({v}, {dashed}, {group[k]}) "
              f"WHEN {c} THEN substring({v}, {pos[k][0]}, {pos[k][1]}) END AS INT)" for k in ("lsd", "sec", "twp", "rng", "mer")}
    return out | {"dir": f"CASE WHEN {d} THEN regexp_extract({v}, {dashed}, 5) WHEN {c} THEN 'W' END"}


def _grid_sqls(q: str, mode: str) -> dict[str, str]:
    """Validity, base longitude and metres north and west of the base, from fields referred to as ``q`` + name."""
    valid = (f"{q}lsd BETWEEN 1 AND 16 AND {q}sec BETWEEN 1 AND 36 AND {q}twp BETWEEN 1 AND 126 "
             f"AND {q}rng BETWEEN 1 AND 34 AND {q}mer IN ({', '.join(str(m) for m in MERIDIAN_BASE_LON)}) "
             f"AND {q}dir IN ('W', 'E')")
    base = "CASE " + " ".join(f"WHEN {q}mer = {m} THEN {_d(lon)}" for m, lon in MERIDIAN_BASE_LON.items()) + " END"
    twp = f"{q}twp" if mode == "as_written" else f"({q}twp - 1)"
    rng = f"{q}rng" if mode == "as_written" else f"({q}rng - 1)"
    sec_row, sec_c = f"(({q}sec - 1) div 6)", f"(({q}sec - 1) % 6)"
    lsd_row, lsd_c = f"(({q}lsd - 1) div 4)", f"(({q}lsd - 1) % 4)"
    sec_col = f"(CASE WHEN {sec_row} % 2 = 1 THEN 5 - {sec_c} ELSE {sec_c} END)"
    lsd_col = lsd_c if mode == "as_written" else f"(CASE WHEN {lsd_row} % 2 = 1 THEN 3 - {lsd_c} ELSE {lsd_c} END)"
    T, S, L = _d(TOWNSHIP_M), _d(SECTION_M), _d(LSD_M)
    # Same evaluation order as the published arithmetic, so doubles agree bit for bit.
    return {"valid": valid, "base": base, "north": f"{twp} * {T} + {sec_row} * {S} + {lsd_row} * {L}",
            "west": f"{rng} * {T} + {sec_col} * {S} + {lsd_col} * {L}"}


def _lat_sql(north: str) -> str:
    return f"{_d(SURVEY_BASE_LAT)} + {north} / {_d(METERS_PER_DEG_LAT)}"


def _lon_sql(lat: str, base: str, west: str, direction: str) -> str:
    per_deg = f"({_d(METERS_PER_DEG_LAT)} * cos({lat} * {_d(DEG2RAD)}))"
    return f"CASE WHEN {direction} = 'W' THEN {base} - {west} / {per_deg} ELSE {base} + {west} / {per_deg} END"


def _round6(x: str) -> str:
    return f"round(({x}) * 1000000.0D, 0) / 1000000.0D"


def parse_sql(raw_sql: str, mode: str = "as_written") -> str:
    """Struct<lsd,sec,twp,rng,mer,dir>; NULL when neither form matches."""
    _check(mode)
    fields = ", ".join(f"'{k}', {x}" for k, x in _field_sqls("m_.v", "m_.d", "m_.c", mode).items())
    matched = _let(normalized_sql(raw_sql), "v_",
                   f"named_struct('v', v_, 'd', v_ rlike {_s(DASHED_LOCATION_RE)}, 'c', v_ rlike {_s(COMPACT_LOCATION_RE)})")
    return _let(matched, "m_", f"CASE WHEN m_.d OR m_.c THEN named_struct({fields}) END")


def locate_sql(parts_sql: str, mode: str = "as_written") -> str:
    """Struct<latitude,longitude> (6 dp) from a parsed location; NULL when out of range."""
    _check(mode)
    g = _grid_sqls("q_.", mode)
    coords = _let(f"named_struct('lat', {_lat_sql('g_.north')}, 'west', g_.west, 'base', g_.base, 'dir', g_.dir)", "h_",
                  f"named_struct('latitude', {_round6('h_.lat')}, "
                  f"'longitude', {_round6(_lon_sql('h_.lat', 'h_.base', 'h_.west', 'h_.dir'))})")
    body = (f"CASE WHEN {g['valid']} THEN "
            + _let(f"named_struct('north', {g['north']}, 'west', {g['west']}, 'base', {g['base']}, 'dir', q_.dir)", "g_", coords)
            + " END")
    return _let(parts_sql, "q_", body)


def geocode_sql(raw_sql: str, mode: str = "as_written") -> str:
    return locate_sql(parse_sql(raw_sql, mode), mode)


def normalized_location(raw: str) -> Column:
    return F.expr(normalized_sql(_ref(raw)))


def parse_location(raw: str, mode: str = "as_written") -> Column:
    """Column of struct<lsd,sec,twp,rng,dir,mer> from the text column named ``raw``."""
    return F.expr(parse_sql(_ref(raw), mode))


def locate(parts: str, mode: str = "as_written") -> Column:
    """Column of struct<latitude,longitude> from the parsed-struct column named ``parts``."""
    return F.expr(locate_sql(_ref(parts), mode))


def geocode(raw: str, mode: str = "as_written") -> Column:
    """Location text column name -> struct<latitude, longitude> or NULL."""
    return F.expr(geocode_sql(_ref(raw), mode))


def with_location(df: DataFrame, raw: str, mode: str = "as_written", lat_out: str = "latitude",
                  lon_out: str = "longitude", located_only: bool = False) -> DataFrame:
    """Add ``lat_out`` / ``lon_out`` geocoded from the location text column ``raw``, row by row.

    No shuffle: each step is a plain generated-code column over the steps before it, and every value is computed
    once. The coordinates leave through ``inline`` of a one-element array, which Catalyst does not push
    predicates through, so a later filter on them reads the values instead of copies of the whole
    expression. ``located_only`` drops rows whose location does not resolve.
    """
    _check(mode)
    keep = [c for c in df.columns if c not in (lat_out, lon_out)]
    q, step = "_loc_", df.select(*keep).withColumn("_loc_v", F.expr(normalized_sql(_ref(raw))))
    step = step.withColumns({"_loc_d": F.expr(f"_loc_v rlike {_s(DASHED_LOCATION_RE)}"),
                             "_loc_c": F.expr(f"_loc_v rlike {_s(COMPACT_LOCATION_RE)}")})
    step = step.withColumns({q + k: F.expr(x) for k, x in _field_sqls("_loc_v", "_loc_d", "_loc_c", mode).items()})
    grid = _grid_sqls(q, mode)
    step = step.withColumns({"_loc_ok": F.expr(grid["valid"])} | {q + k: F.expr(grid[k]) for k in ("base", "north", "west")})
    step = step.withColumn("_loc_lat", F.expr(f"CASE WHEN _loc_ok THEN {_lat_sql('_loc_north')} END"))
    point = F.struct(F.expr(_round6("_loc_lat")).alias(lat_out),
                     F.expr(_round6(_lon_sql("_loc_lat", "_loc_base", "_loc_west", "_loc_dir"))).alias(lon_out))
    out = step.select(*keep, F.inline(F.array(point)))
    return out.where(F.col(lat_out).isNotNull()) if located_only else out
