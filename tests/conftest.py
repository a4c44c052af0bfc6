import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from tidewatch import get_session

    session = get_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.driver.memory": "6g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def series(spark):
    """``(series, ts, value)`` from ``{series: [(seconds, value), …]}``."""
    from pyspark.sql import functions as F

    def make(data):
        rows = [(s, int(round(at * 1e6)), None if v is None else float(v)) for s, points in data.items() for at, v in points]
        frame = spark.createDataFrame(rows, "series string, us bigint, value double")
        return frame.select("series", F.timestamp_micros("us").alias("ts"), "value")

    return make
