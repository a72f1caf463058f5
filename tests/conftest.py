import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fieldgauge.schemas import OBSERVATION_SCHEMA  # noqa: E402
from fieldgauge.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def reading():
    """Builds one observation tuple; anything not given is ordinary."""

    def build(**given):
        row = {
            "dt": "2024-01-15",
            "sensor_id": "SENSOR_0001",
            "region": "ZONE_0_0",
            "latitude": 52.27,
            "longitude": 13.155,
            "temperature_max": 8.5,
            "temperature_min": 2.5,
            "precipitation": 1.0,
            "source": "test",
            "ingestion_timestamp": "2024-01-15T10:00:00",
        }
        row.update(given)
        return tuple(row[name] for name in OBSERVATION_SCHEMA.names)

    return build


@pytest.fixture
def readings(spark, reading):
    def build(*rows):
        return spark.createDataFrame([reading(**r) for r in rows], OBSERVATION_SCHEMA)

    return build


@pytest.fixture(scope="session")
def final_plan():
    def text(df):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        return plan.split("== Initial Plan ==")[0]

    return text
