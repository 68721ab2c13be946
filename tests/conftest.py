import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from credence.session import local_session

    s = local_session(4, shuffle_partitions=4, app="credence-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF0001
