import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from chronofold.session import get_spark

    s = get_spark("tests", "local[4]", **{"spark.sql.shuffle.partitions": 4, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def day():
    return lambda n, h=0: dt.datetime(2020, 1, 1) + dt.timedelta(days=n, hours=h)
