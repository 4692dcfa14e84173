import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=8, app_name="tessera-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from tests.oracle_check import duck
    return duck(SF_SMALL)


@pytest.fixture(scope="session")
def duck_check():
    from tests.oracle_check import duck
    return duck(SF_CHECK)
