import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from inkgraph.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    active = session(
        "inkgraph-tests", master="local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="4",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="inkgraph-warehouse-"),
    )
    active.sparkContext.setLogLevel("ERROR")
    yield active
    active.stop()
