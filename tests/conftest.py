import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("SKYLEDGER_SCRATCH", tempfile.mkdtemp(prefix="skyledger-tests-", dir="/tmp"))
    from skyledger.session import build_session
    s = build_session("local[4]", app="skyledger-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from skyledger.session import scratch_path
    return scratch_path(spark, "t")
