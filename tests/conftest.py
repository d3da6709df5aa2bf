import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]
os.environ.setdefault("MILLRACE_DRIVER_MEMORY", "4g")

DATA = os.environ.get("MILLRACE_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from millrace.session import local_session

    s = local_session(8)
    s.conf.set("spark.sql.shuffle.partitions", "4")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def sf01():
    return f"{DATA}/sf0.01"
