import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from wardlake.session import get_session
    s = get_session("local[4]", 4, "wardlake-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def scratch(spark):
    from wardlake.session import scratch_path
    return lambda name="t": scratch_path(spark, name)
