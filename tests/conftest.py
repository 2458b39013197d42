import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from churnkit.session import local_session, checkpoint_dir
    s = local_session(8)
    checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def con01():
    from tools.oracle_check import duck
    return duck(SF01)
