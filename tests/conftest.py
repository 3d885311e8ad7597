import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pluvio.session import local_session
    s = local_session("4", app="pluvio-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def obs_small(spark):
    from pluvio.sources.obs import obs
    return obs(spark, SF_SMALL)
