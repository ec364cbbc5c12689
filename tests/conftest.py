import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from spokeline import schemas, session  # noqa: E402
from spokeline.operators import staging  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        session.builder("tests")
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


TRIP = {
    "ride_id": "R1",
    "rideable_type": "classic_bike",
    "started_at": ts("2024-03-04 08:00:00"),
    "ended_at": ts("2024-03-04 08:10:00"),
    "start_station_name": "A",
    "start_station_id": "1",
    "end_station_name": "B",
    "end_station_id": "2",
    "start_lat": 40.7,
    "start_lng": -74.0,
    "end_lat": 40.71,
    "end_lng": -74.01,
    "member_casual": "member",
}


@pytest.fixture
def trips(spark):
    """Trips that differ from a plain one in the given fields."""

    def build(*changes: dict):
        rows = [tuple((TRIP | c)[n] for n in schemas.TRIPS.names) for c in changes]
        return spark.createDataFrame(rows, schemas.TRIPS.struct)

    return build


@pytest.fixture
def raw(trips):
    return lambda *changes: staging.with_lineage(trips(*changes))
