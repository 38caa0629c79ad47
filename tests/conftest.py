import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import clear_scratch, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=8, shuffle_partitions=8)
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("MILLRACE_TEST_DIR", "/root/testdata/sf0.001")
