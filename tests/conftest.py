from __future__ import annotations

import pytest

from telescale.operators.ordered import ROWS_KEY
from telescale.session import build_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        app_name="tests", master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=[False, True], ids=["plain", "hot"])
def hot(request, spark):
    """Both ways of ordered passes; the second cuts keys into blocks of a few rows."""
    if request.param:
        spark.conf.set(ROWS_KEY, "3")
    yield request.param
    spark.conf.unset(ROWS_KEY)
