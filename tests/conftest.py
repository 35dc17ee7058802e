import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from plumeline.session import build_session
    scratch = tempfile.mkdtemp(prefix="plumeline-tests-")
    s = build_session("local[4]", app="plumeline-tests", shuffle_partitions=4,
                      extra={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="plumeline-case-")
