import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("HOURCAST_SCRATCH", tempfile.mkdtemp(prefix="hourcast-test-", dir="/tmp"))


@pytest.fixture(scope="session")
def spark():
    from hourcast.session import local_session

    s = local_session("*", shuffle_partitions=8, app="hourcast-tests")
    yield s
    s.stop()
