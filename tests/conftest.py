import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from brooktext.session import local_session  # noqa: E402
from brooktext.sources.workspace import release  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, app="tests", memory="4g")
    yield session
    release(session)
    session.stop()


@pytest.fixture
def records(spark):
    """Small labelled records with a clear class difference and an empty text."""
    good = ["good fine day", "fine good good", "a good day, really", "day of fine weather", "good"]
    bad = ["bad rain", "rain rain bad night", "bad bad night, rain", "night"]
    rows = [(i, "4", text) for i, text in enumerate(good)] + [(10 + i, "0", text) for i, text in enumerate(bad)]
    rows.append((20, "4", ""))
    return spark.createDataFrame(rows, "row_id bigint, sentiment string, message string")
