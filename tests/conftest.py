import datetime as dt
import os

import pytest

from tierflow.session import create_session
from tierflow.settings import Settings

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = create_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "2",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(TESTDATA):
        pytest.skip("no test tables")
    return TESTDATA


@pytest.fixture
def settings(tmp_path):
    return Settings(
        message_format="parquet",
        topic=str(tmp_path / "topic"),
        table_root=str(tmp_path / "tables"),
        checkpoint_root=str(tmp_path / "checkpoints"),
        trigger={"availableNow": True},
    )


@pytest.fixture
def zone(spark):
    """Set the session zone for one test."""
    before = spark.conf.get("spark.sql.session.timeZone")
    yield lambda name: spark.conf.set("spark.sql.session.timeZone", name)
    spark.conf.set("spark.sql.session.timeZone", before)


_TYPES = {"age": "int", "kafka_timestamp": "timestamp_ntz", "offset": "bigint", "partition": "int"}
_FIELDS = (
    "user_id", "uuid", "email", "name", "age", "country", "fetched_at", "source", "api_version",
    "kafka_timestamp", "offset", "partition",
)
_GOOD = {
    "user_id": "1", "uuid": "u-1", "email": "a@b.co", "name": "Ann", "age": 30, "country": "TH",
    "fetched_at": "2024-01-02T03:04:05", "source": "s", "api_version": "v2",
    "kafka_timestamp": dt.datetime(2024, 1, 2, 3, 4, 5), "offset": 0, "partition": 0,
}


@pytest.fixture
def users(spark):
    """Raw user rows: a good record with the given changes, offsets counting up."""

    def make(*changes):
        rows = [{**_GOOD, "offset": i, **change} for i, change in enumerate(changes)]
        schema = ", ".join(f"`{f}` {_TYPES.get(f, 'string')}" for f in _FIELDS)
        return spark.createDataFrame([tuple(r[f] for f in _FIELDS) for r in rows], schema)

    return make
