import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from sparksweep.session import local_session
    s = local_session(cpus="*", shuffle_partitions=8, app="sparksweep-tests")
    yield s
    from sparksweep.session import remove_scratch
    remove_scratch(s)
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
