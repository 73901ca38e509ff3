import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerlens.session import get_session
    s = get_session("local[8]", 8)
    yield s


@pytest.fixture(scope="session")
def duck_small():
    from oracle_check import duck
    return duck(SMALL)
