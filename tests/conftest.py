import os
import sys
import time

import pytest

os.environ["TZ"] = "UTC"
time.tzset()
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from dustline.session import build_session
    s = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.host": "127.0.0.1"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
