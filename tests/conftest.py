import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from riskmart.session import build_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    work = tempfile.mkdtemp(prefix="riskmart-tests-")
    s = build_session("local[*]", shuffle_partitions=8, app_name="riskmart-tests",
                      extra={"spark.checkpoint.dir": work})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="riskmart-t-")
