import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from civicstat.session import build_session
    s = build_session("local[4]", shuffle_partitions=8, app_name="civicstat-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="civicstat-test-")


SF = "/root/testdata/sf0.001"
