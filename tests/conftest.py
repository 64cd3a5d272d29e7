import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from moodlens.session import build_session  # noqa: E402

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "moodlens-tests",
        "local[8]",
        {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "6g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{TESTDATA}/sf0.001"
