import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("CIVICSPARK_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from civicspark.session import build_session, cleaned

    s = build_session("local[4]", 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    cleaned(s)
    s.stop()


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("no test data")
    return DATA
