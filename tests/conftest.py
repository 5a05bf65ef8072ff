import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from capsieve.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "capsieve-tests", **{"spark.python.sql.dataFrameDebugging.enabled": "false"})


def one(df):
    """Single row of a frame as a dict."""
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict(recursive=True)
