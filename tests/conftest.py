import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from paritas.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("paritas-tests", "local[*]", **{"spark.sql.shuffle.partitions": "8"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
