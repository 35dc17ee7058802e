"""Property tests: random batches through Spark against plain-Python statements."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from plumeline.functions.location import with_location
from plumeline.operators.spatial import distance_inner_join, distance_semi_join
from tests.oracle_compare import duck_geocode
from tests.test_spatial import hav

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

parts = st.tuples(st.integers(0, 18), st.integers(0, 38), st.integers(0, 130), st.integers(0, 36),
                  st.sampled_from(["W", "E", "X"]), st.integers(3, 7))


def _dashed(p):
    lsd, sec, twp, rng, d, mer = p
    return f"{lsd:02d}-{sec:02d}-{twp:03d}-{rng:02d}{d}{mer}"


def _compact(p, mode):
    lsd, sec, twp, rng, _, mer = p
    if mode == "as_written":
        return f"{mer:02d}{twp % 100:02d}{rng:02d}{sec:02d}{lsd:02d}"
    return f"{twp:03d}{mer}{rng:02d}{sec:02d}{lsd:02d}"


@SETTINGS
@given(st.lists(parts, min_size=20, max_size=120), st.sampled_from(["as_written", "corrected"]))
def test_geocode_matches_python_statement(spark, batch, mode):
    texts = []
    for p in batch:
        texts.append(_dashed(p))
        if p[3] < 100 and p[0] < 100:
            texts.append(_compact(p, mode))
    df = spark.createDataFrame(list(enumerate(texts)), "i int, loc string")
    got = {r.i: (r.latitude, r.longitude) for r in with_location(df, "loc", mode).collect()}
    want = duck_geocode(texts, mode)                 # the oracle's SQL statement, in DuckDB
    for i, t in enumerate(texts):
        if want[i][0] is None:
            assert got[i] == (None, None), t
        else:
            assert math.isclose(got[i][0], want[i][0], abs_tol=1.5e-6), t
            assert math.isclose(got[i][1], want[i][1], abs_tol=1.5e-6), t


points = st.lists(st.tuples(st.floats(49.0, 70.0), st.floats(-121.0, -109.0)), min_size=5, max_size=80)


@SETTINGS
@given(points, points, st.floats(500.0, 60000.0))
def test_distance_joins_match_brute_force(spark, left, right, radius):
    ldf = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(left)], "id int, latitude double, longitude double")
    rdf = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(right)], "rid int, latitude double, longitude double")
    pairs = {(i, j) for i, (a, b) in enumerate(left) for j, (c, d) in enumerate(right) if hav(a, b, c, d) <= radius}
    assert {r.id for r in distance_semi_join(ldf, rdf, radius).collect()} == {i for i, _ in pairs}
    assert sorted((r.id, r.r_rid) for r in distance_inner_join(ldf, rdf, radius).collect()) == sorted(pairs)


numeric_text = st.builds(
    lambda pre, sign, a, dot, b, exp, junk, post: f"{pre}{sign}{a}{dot}{b}{exp}{junk}{post}",
    st.sampled_from(["", " ", "  ", "\t"]), st.sampled_from(["", "+", "-", "--"]),
    st.text("0123456789", max_size=4), st.sampled_from(["", ".", ".."]), st.text("0123456789", max_size=3),
    st.sampled_from(["", "e3", "E-2", "e", "e+10"]), st.sampled_from(["", "", "", "d", ",", "x", "_1", " 1"]),
    st.sampled_from(["", " ", "\n"]))


@SETTINGS
@given(st.lists(numeric_text | st.sampled_from(["inf", "-Infinity", "nan", "n/a", ""]), min_size=20, max_size=200))
def test_lenient_double_matches_pandas_coercion(spark, texts):
    import pandas as pd

    from plumeline.functions.numeric import lenient_double
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.v for r in df.select("i", lenient_double("t").alias("v")).collect()}
    want = pd.to_numeric(pd.Series(texts, dtype=object), errors="coerce")
    for i, t in enumerate(texts):
        w = None if pd.isna(want[i]) else float(want[i])
        assert got[i] == w, (t, got[i], w)
