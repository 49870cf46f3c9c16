import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wearlens.contract import SENSORS  # noqa: E402
from wearlens.session import local_session  # noqa: E402

READING = "type string, unit_id long, " + ", ".join(f"{c} double" for c in SENSORS)
BASE = {
    "air_temperature_k": 300.0, "process_temperature_k": 310.0, "rotational_speed_rpm": 1500.0, "torque_nm": 40.0,
    "tool_wear_min": 0.0,
}


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def readings(spark):
    """``(key, changes)`` pairs in arrival order as a frame."""

    def make(*pairs):
        rows = [(k, i, *{**BASE, **changes}.values()) for i, (k, changes) in enumerate(pairs)]
        return spark.createDataFrame(rows, READING)

    return make
