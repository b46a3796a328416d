import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from corvid.session import build_session
    s = build_session("local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from corvid.plans.verify import duck_connect
    from testdata import SF_SMALL
    return duck_connect(SF_SMALL)
