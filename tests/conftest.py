import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from helpers import SCHEMA  # noqa: E402
from tocsin.session import get_session, new_path  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def path(spark):
    return lambda label="t": new_path(spark, label)


@pytest.fixture
def incidents(spark):
    """A small table with every kind of hole: null key, null value, null zone,
    null severity, repeated key, odd case and spaces."""
    t = datetime(2026, 4, 17, 11, 14, 46, 311553)
    rows = [
        ("a1", t, "Fire", "Critical", "North", 120.0),
        ("a2", t, "Fire", "critical", "North", 3599.0),
        ("a3", t, "Medical", " HIGH ", "South", None),
        ("a4", t, "Medical", None, "South", 3600.0),
        ("a5", t, "Police", "low", None, 2400.0),
        ("a5", t, "Police", "low", "East", 2401.0),
        (None, t, "Police", "medium\t", "East", 9000.0),
        ("a7", t, None, "severe", "East", -5.0),
    ]
    return spark.createDataFrame(rows, SCHEMA)
