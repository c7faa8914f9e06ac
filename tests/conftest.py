import sys, pathlib

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

import datetime as dt

import pytest

from tickengine.session import build_session

@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        conf={
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def ticks_of(spark):
    """Ticks from ``(ticker, price, volume, "HH:MM:SS[.ffffff]")`` on one day."""

    def make(rows, day="2024-06-03"):
        data = [(t, p, v, dt.datetime.fromisoformat(f"{day}T{at}+00:00")) for t, p, v, at in rows]
        return spark.createDataFrame(
            data, "ticker string, price double, volume long, event_time timestamp"
        )

    return make


@pytest.fixture
def messages_of(spark):
    """Messages with a binary body, as a bus delivers them."""

    def make(bodies):
        rows = [(None if b is None else bytearray(b, "utf-8"),) for b in bodies]
        return spark.createDataFrame(rows, "value binary")

    return make
