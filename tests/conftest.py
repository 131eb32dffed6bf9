import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from seatflow.runtime import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def plan_of():
    def text(df, mode="formatted"):
        return df._jdf.queryExecution().executedPlan().toString()

    return text
