import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

SF = os.environ.get("WATTLAKE_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from wattlake.session import local_session

    s = local_session("4", 4, "tests")
    s.sparkContext.setLogLevel("OFF")
    return s


@pytest.fixture(scope="session")
def sf():
    return SF
