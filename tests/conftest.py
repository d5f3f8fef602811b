import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.oracle import connect, session

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    return session()


@pytest.fixture(scope="session")
def duck():
    return connect(SF_DIR)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
