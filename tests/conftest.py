import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
# Python workers inherit this, so classes defined in test modules unpickle there.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [ROOT, os.path.join(ROOT, "tests")] + [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p])

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from loglens import build_session
    s = build_session("local[*]", app_name="loglens-tests", shuffle_partitions=8,
                      extra={"spark.ui.showConsoleProgress": "false",
                             "spark.driver.memory": "4g"})
    yield s
    s.stop()
