import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"
CHECKED = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from orevein.session import local_session

    session = local_session(os.environ.get("TEST_CPUS", "*"))
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def small():
    return SMALL
