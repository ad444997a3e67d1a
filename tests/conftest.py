from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for place in (ROOT, os.path.join(ROOT, "tests")):
    if place not in sys.path:
        sys.path.insert(0, place)


@pytest.fixture(scope="session")
def spark():
    from millrace.session import build_session

    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
