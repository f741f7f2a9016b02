import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from threadloom.session import build_session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions=4, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="6g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate one column over a one-row frame of given values."""
    from pyspark.sql import functions as F

    def run(make, *values):
        frame = spark.createDataFrame([tuple(values)], [f"c{i}" for i in range(len(values))])
        return frame.select(make(*[F.col(f"c{i}") for i in range(len(values))]).alias("out")).first()["out"]

    return run
