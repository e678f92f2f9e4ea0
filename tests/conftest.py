import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from featuremill.session import get_session, scratch_dir
    s = get_session("local[4]", app="featuremill-tests", shuffle_partitions=8,
                    driver_memory="8g")
    scratch_dir(s)  # local tests: a fresh temporary checkpoint folder
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    from featuremill.plans.oracle import duckdb_views
    return duckdb_views(SF01)
