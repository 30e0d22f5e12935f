from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from kerbside.session import build_session

    session = build_session(
        "tests", master="local[4]", **{"spark.sql.shuffle.partitions": "4",
                                       "spark.driver.memory": "4g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def marts(spark):
    from kerbside.bindings.marts import Marts

    return Marts(spark, SF)
