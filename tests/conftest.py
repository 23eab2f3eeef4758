import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cellscope.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(master="local[4]", app="cellscope-tests", shuffle_partitions=4,
                            extra={"spark.sql.warehouse.dir":
                                   tempfile.mkdtemp(prefix="cellscope-wh-")})
    yield session
    session.stop()


@pytest.fixture()
def workdir():
    """A fresh scratch folder per test (never cleaned by rm)."""
    return tempfile.mkdtemp(prefix="cellscope-test-")
