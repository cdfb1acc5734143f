import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from flowlens.config import build_session

    s = build_session("local[4]", 8, app="flowlens-tests")
    yield s
    s.stop()


@pytest.fixture
def workdir(spark):
    """A fresh folder under the session's checkpoint folder."""
    import uuid

    from flowlens.config import scratch_path

    return scratch_path(spark, "tests", uuid.uuid4().hex)
