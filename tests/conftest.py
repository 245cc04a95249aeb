import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from hirelake.session import local_session
    s = local_session(4, 4, app="hirelake-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def smoke_dir():
    return SMOKE
