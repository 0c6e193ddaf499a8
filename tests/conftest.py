import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pktscope.session import local_session
    s = local_session(8, 8, app_name="pktscope-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_str(tmp_path):
    return str(tmp_path)
