import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from prioritext.session import get_session

    s = get_session("local[4]", shuffle_partitions=4, extra_conf={"spark.driver.memory": "8g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf001():
    return SF001


@pytest.fixture(scope="session")
def sf01():
    return SF01
