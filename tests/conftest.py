import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerlens.session import get_spark

    s = get_spark(app="ledgerlens-tests", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def duck_small():
    from oracle_compare import duck

    return duck(SF_SMALL)
