import datetime as dt
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tierflow.operators.messages import decode_messages, split_malformed
from tierflow.operators.unique import unique_records
from tierflow.plans import inputs
from tierflow.schemas import BRONZE_SCHEMA, ENVELOPE_SCHEMA
from tierflow.sources.messages import stream_messages
from tierflow.sources.tables import read_table
from tierflow.streaming import jobs
from tierflow.streaming.supervision import LayerFailed, LayerMonitor, supervise
from tierflow.streaming.writers import writes
from tests.test_streaming import T0, finish, send


def failing(times, write):
    left = [times]

    def run(df, batch_id):
        if left[0]:
            left[0] -= 1
            raise RuntimeError("target went away")
        write(df, batch_id)

    return writes(run)


def starters(spark, settings, times):
    """A layer that runs on, and one that fails a number of times."""
    decoded = decode_messages(stream_messages(spark, settings))
    flaky = failing(times, jobs.table_writer(jobs.target(settings, "flaky")))
    return {
        "bronze": lambda: jobs.bronze_query(decoded, settings),
        "flaky": lambda: jobs.start(decoded, "flaky", flaky, settings),
    }


def test_a_failed_layer_is_restarted_and_counted(spark, users, settings):
    send(users({}, {"offset": 1}), settings)
    monitor = LayerMonitor()
    spark.streams.addListener(monitor)
    try:
        assert supervise(spark, starters(spark, settings, 2), restarts=2, pause=0.1) == {"bronze": 0, "flaky": 2}
        # Events come a little after the queries have ended.
        for _ in range(150):
            seen = monitor.queries
            if all(name in seen and seen[name].rows == 2 for name in ("bronze_writer", "flaky")) and len(seen["flaky"].failures) == 2:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(monitor)
    assert monitor.queries["bronze_writer"].rows == 2 and len(monitor.queries["flaky"].failures) == 2
    assert read_table(spark, jobs.table_name(settings, "flaky")).count() == 2


def test_others_stop_when_one_fails_for_good(spark, users, settings):
    send(users({}), settings)
    ticking = replace(settings, trigger={"processingTime": "1 second"})
    with pytest.raises(LayerFailed, match="flaky failed after 1 restarts"):
        supervise(spark, starters(spark, ticking, 99), restarts=1, pause=0.1)
    assert not spark.streams.active


def test_repeats_across_batches_and_bounded_state(spark, users, settings):
    def run():
        decoded = unique_records(decode_messages(stream_messages(spark, settings)), "1 hour")
        return finish(jobs.start(decoded, "unique", jobs.table_writer(jobs.target(settings, "unique")), settings))

    def at(minutes, offset, **more):
        return {"kafka_timestamp": T0 + dt.timedelta(minutes=minutes), "offset": offset, **more}

    # The same record twice in one batch, then in the next after a restart.
    send(users(at(0, 0), at(1, 1), at(2, 2, uuid="other")), settings)
    run()
    send(users(at(30, 3), at(31, 4, uuid="third")), settings)
    query = run()
    table = read_table(spark, jobs.table_name(settings, "unique"))
    assert sorted(r.uuid for r in table.collect()) == ["other", "third", "u-1"]
    # The watermark moves after a batch: the first of these is still known as a repeat,
    # then what is remembered is let go and the next one counts anew.
    for minutes in (600, 1200):
        send(users(at(minutes, minutes)), settings)
        query = run()
    table = read_table(spark, jobs.table_name(settings, "unique"))
    assert sorted(r.uuid for r in table.collect()) == ["other", "third", "u-1", "u-1"]
    assert query.lastProgress is None or sum(s.numRowsTotal for s in query.lastProgress.stateOperators) <= 2


def envelopes(spark, *values):
    rows = [(None, None if v is None else v.encode(), "t", 0, i, T0) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, ENVELOPE_SCHEMA)


def test_malformed_messages_are_set_aside(spark):
    values = ['{"user_id":"1","age":3}', '{"user_id":"2","age":"x"}', '{"user_id":"3"', "no", "", "  ", None, "{}", "5", '{"age":"x"}']
    sent = envelopes(spark, *values)
    good, broken = split_malformed(decode_messages(sent, malformed=True))
    assert [(r.offset, r.value, r.error_type) for r in broken.orderBy("offset").collect()] == [
        (2, '{"user_id":"3"', "MALFORMED_JSON"), (3, "no", "MALFORMED_JSON"), (4, "", "EMPTY_MESSAGE"),
        (5, "", "EMPTY_MESSAGE"), (6, "", "EMPTY_MESSAGE"), (8, "5", "MALFORMED_JSON"), (9, '{"age":"x"}', "MALFORMED_JSON"),
    ]
    plain = decode_messages(sent).filter(F.col("offset").isin(0, 1, 7))
    assert good.columns == plain.columns
    assert sorted(map(tuple, good.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    for part in (good, broken):
        assert part._jdf.queryExecution().executedPlan().toString().count("from_json") == 1


def test_bronze_with_a_table_for_malformed_messages(spark, users, settings):
    splitting = replace(settings, split_malformed=True)
    envelopes(spark, "no", None).write.mode("append").parquet(settings.topic)
    send(users({"offset": 7}), settings)
    for _ in range(2):
        for query in jobs.run_layers(spark, splitting, ["bronze"]):
            finish(query)
    bronze = read_table(spark, jobs.table_name(settings, "bronze_users"), schema=BRONZE_SCHEMA)
    assert [r.offset for r in bronze.collect()] == [7]
    assert read_table(spark, jobs.table_name(settings, "malformed_messages")).count() == 2


def test_faulty_input_has_all_kinds(spark, sf_dir):
    sent = inputs.faulty(inputs.envelopes(inputs.raw_users(inputs.events(spark, sf_dir))))
    kinds = split_malformed(decode_messages(sent, malformed=True))[1].groupBy("error_type").count().collect()
    assert {r.error_type for r in kinds} == {"MALFORMED_JSON", "EMPTY_MESSAGE"}
