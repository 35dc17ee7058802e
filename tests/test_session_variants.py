"""Results do not depend on session settings a deployment may choose differently."""

import pytest

from tests.conftest import SF_ORACLE
from tests.oracle_compare import compare

NAMES = ["numeric_coercion", "pixel_coverage", "monthly_production", "silver_pixels", "append_row_ids",
         "facility_pixel_agg", "geocode_batteries", "rejected_granules"]
VARIANTS = {
    "ansi_off": {"spark.sql.ansi.enabled": "false"},
    "zone_edmonton": {"spark.sql.session.timeZone": "America/Edmonton"},
    "aqe_off": {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "3"},
}


@pytest.mark.parametrize("variant", sorted(VARIANTS))
def test_queries_match_oracle_under_session_variant(spark, variant):
    settings = VARIANTS[variant]
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        res = compare(spark, SF_ORACLE, NAMES, verbose=False)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert all(v.startswith("OK") for v in res.values()), res
