"""Run catalogue queries in Spark and their SQL in DuckDB; compare like the driver does."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    con.execute("SET enable_progress_bar=false")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if v is None:
        return "None"
    if hasattr(v, "item"):
        return _norm(v.item())
    return repr(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows), [cols[i] for i in order]


def compare(spark, sf_dir, names=None, verbose=True):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:400]}"
            print(name, results[name]) if verbose else None
            continue
        ts = time.time() - t
        if name not in sql:
            results[name] = f"no oracle ({len(srows)} rows)"
            print(name, results[name]) if verbose else None
            continue
        try:
            cur = con.execute(sql[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = f"DUCK ERROR {str(e)[:600]}"
            print(name, results[name]) if verbose else None
            continue
        sr, sc = rows_of(scols, srows)
        dr, dc = rows_of(dcols, drows)
        if sc != dc:
            results[name] = f"COLUMNS differ spark={sc} duck={dc}"
        elif len(sr) != len(dr):
            results[name] = f"ROWCOUNT spark={len(sr)} duck={len(dr)}"
        elif sr != dr:
            diff = [(a, b) for a, b in zip(sr, dr) if a != b]
            results[name] = f"VALUES differ in {len(diff)} rows, e.g. {diff[:2]}"
        else:
            results[name] = f"OK ({len(sr)} rows, {ts:.1f}s)"
        if verbose:
            print(name, results[name], flush=True)
    return results


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from plumeline.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2].split(",") if len(sys.argv) > 2 else None
    spark = build_session("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if not v.startswith("OK")}
    print(f"{len(res) - len(bad)}/{len(res)} OK")


def duck_geocode(texts, mode="as_written"):
    """Geocode ``texts`` with the oracle's SQL statement in DuckDB: {index: (latitude, longitude)}."""
    from plumeline.plans.oracle import _geocode_cte
    con = duckdb.connect()
    con.execute("create table src(i integer, loc varchar)")
    con.executemany("insert into src values (?, ?)", [(i, t) for i, t in enumerate(texts)])
    sql = f"""with batteries as (
        select i as row_id, null::varchar as facility_id, null::varchar as licence, null::varchar as operator,
          null::varchar as facility_type, null::varchar as facility_description, date '2024-01-01' as reporting_month,
          loc as bty_location_raw, null::double as gas_prod_1000m3, null::double as gas_flared_1000m3,
          null::double as gas_vented_1000m3, null::double as oil_prod_m3, null::double as water_prod_m3,
          null::int as total_wells, null::varchar as gas_prod_text from src),
      {_geocode_cte("g", mode)}
      select row_id, latitude, longitude from g"""
    return {r[0]: (r[1], r[2]) for r in con.execute(sql).fetchall()}
