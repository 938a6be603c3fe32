import os
import sys
import time

import pytest

os.environ["TZ"] = "UTC"  # Python and Spark read naive datetimes the same way
time.tzset()

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    yield session
    session.stop()


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()
