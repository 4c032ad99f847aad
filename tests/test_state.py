"""Layers in sessions that do not say where streaming state lives."""

from dataclasses import replace

import duckdb
import pytest

import check_oracles
from tierflow.plans import catalog
from tierflow.session import PROVIDER, STATE
from tierflow.sinks.commits import CommitLog
from tierflow.streaming import jobs
from tests.test_streaming import finish, send


@pytest.fixture
def unset(spark):
    """The test session without its settings for state, as other sessions are."""
    before = {key: spark.conf.get(key) for key in STATE}
    for key in STATE:
        spark.conf.unset(key)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture(scope="module")
def events(tmp_path_factory):
    """A few events of five days, some users often, and a connection that sees them."""
    folder = tmp_path_factory.mktemp("events")
    con = duckdb.connect()
    con.execute(f"""COPY (
        SELECT i AS event_id, TIMESTAMP '2024-01-01 00:00:07' + INTERVAL (i * 2400) SECOND AS ts, i % 13 AS user_id,
            CASE i % 3 WHEN 0 THEN 'click' ELSE 'signup' END AS event_type, '{{"k": 1}}' AS props
        FROM range(180) AS numbers(i)) TO '{folder}/events.parquet'""")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet'")
    return str(folder), con


def test_layers_without_state_leave_the_session_alone(spark, users, settings, unset):
    send(users({}, {"offset": 1}), settings)
    for layers in (("bronze", "cleaned"), ("silver", "dlq", "latest", "daily")):
        for query in jobs.run_layers(spark, settings, layers):
            finish(query)
    assert all(spark.conf.get(key, None) is None for key in STATE)


@pytest.mark.parametrize("layer, name", [("bronze", "bronze_writer"), ("cleaned", jobs.CLEANED)])
@pytest.mark.parametrize("said", [None, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"])
def test_state_is_on_disk_in_any_session(spark, users, settings, unset, layer, name, said):
    if said:
        spark.conf.set(PROVIDER, said)
    send(users({}, {"offset": 1}), settings)
    for query in jobs.run_layers(spark, replace(settings, unique_within="1 hour"), [layer]):
        finish(query)
    assert STATE[PROVIDER] in spark.read.text(f"{settings.checkpoint_root}/{name}/offsets/0", wholetext=True).first()[0]
    assert spark.conf.get(PROVIDER, None) == said


QUERIES = [
    "stream_late_rows",
    "stream_malformed_messages",
    "stream_merged_gold",
    "stream_merged_latest_users",
    "stream_new_checkpoint",
    "stream_unique_records",
]


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql_in_any_session(spark, unset, events, name):
    folder, con = events
    assert check_oracles.compare(spark, con, folder, name) is None


@pytest.fixture(scope="module")
def same_ids(tmp_path_factory, events):
    """The same events with two ids only."""
    folder, con = tmp_path_factory.mktemp("same_ids"), duckdb.connect()
    con.execute(f"""COPY (SELECT 30 + event_id % 2 AS event_id, * EXCLUDE (event_id) FROM '{events[0]}/events.parquet')
        TO '{folder}/events.parquet'""")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet'")
    return str(folder), con


MERGED = [("stream_merged_gold", "daily"), ("stream_merged_latest_users", "latest")]


@pytest.mark.parametrize("name, layer", MERGED)
def test_merged_batches_are_four_whatever_the_ids(spark, same_ids, monkeypatch, name, layer):
    folder, con = same_ids
    made, many = [], catalog._many_batches
    monkeypatch.setattr(catalog, "_many_batches", lambda *args: made.append(many(*args)) or made[-1])
    assert check_oracles.compare(spark, con, folder, name) is None
    assert CommitLog(spark, jobs.table_name(made[0], jobs.CLEANED)).newest() == 3
