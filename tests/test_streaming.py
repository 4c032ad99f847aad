import datetime as dt
import random
from dataclasses import replace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tierflow.operators.gold import DAILY, HOURLY, country_stats, current_gold
from tierflow.operators.latest import current_latest_users, latest_users
from tierflow.operators.messages import decode_messages, encode_gold
from tierflow.operators.silver import INPUT_FIELDS, clean_users, invalid_users, valid_users
from tierflow.plans import inputs
from tierflow.schemas import BRONZE_SCHEMA, SILVER_SCHEMA
from tierflow.sinks.tables import remove_folder
from tierflow.sources.messages import stream_messages
from tierflow.sources.relations import list_streams
from tierflow.sources.tables import read_table, stream_table
from tierflow.streaming import jobs
from tierflow.streaming.stats import stream_country_stats

T0 = dt.datetime(2024, 1, 2)


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


def some_users(users, n, seed, first_offset=0, hours=60):
    rng = random.Random(seed)
    return users(
        *(
            {
                "user_id": "hot" if rng.random() < 1 / 3 else rng.choice([None, "1", "2", "3"]),
                "uuid": rng.choice([None, "u1"]),
                "age": rng.choice([None, 5, 20, 70]),
                "country": rng.choice(["th", "US", "uk"]),
                "kafka_timestamp": T0 + dt.timedelta(minutes=rng.randrange(60 * hours)),
                "partition": rng.randrange(3),
                "offset": first_offset + i,
            }
            for i in range(n)
        )
    )


def send(raw, settings):
    inputs.envelopes(inputs.as_instants(_all_fields(raw))).write.mode("append").parquet(settings.topic)


def _all_fields(raw):
    from tierflow.schemas import USER_SCHEMA

    absent = {f.name: F.lit(None).cast(f.dataType) for f in USER_SCHEMA if f.name not in raw.columns}
    wide = raw.withColumns(absent)
    return wide.select(*USER_SCHEMA.fieldNames(), "kafka_timestamp", "offset", "partition")


def cleaned_stream(spark, settings):
    return clean_users(decode_messages(stream_messages(spark, settings), INPUT_FIELDS), keep_envelope=True)


def finish(query):
    query.awaitTermination()
    return query


def gold_log(spark, settings, shape):
    return read_table(spark, jobs.table_name(settings, shape.name))


@pytest.mark.parametrize("shape", [DAILY, HOURLY])
def test_exact_stream_equals_batch_over_several_runs(spark, users, settings, shape):
    parts = [some_users(users, 150, seed, first_offset=1000 * seed) for seed in range(3)]
    for raw in parts:
        send(raw, settings)
        finish(jobs.gold_query(cleaned_stream(spark, settings), shape, settings))
    everything = parts[0].unionByName(parts[1]).unionByName(parts[2])
    expected = country_stats(valid_users(clean_users(everything, keep_envelope=True)), shape)
    log = gold_log(spark, settings, shape)
    assert bag(current_gold(log, shape)) == bag(expected)
    assert log.select("batch_id").distinct().count() == 3


def test_both_shapes_from_one_rollup(spark, users, settings):
    parts = [some_users(users, 150, seed, first_offset=1000 * seed) for seed in range(2)]
    for raw in parts:
        send(raw, settings)
        finish(jobs.gold_query(cleaned_stream(spark, settings), (DAILY, HOURLY), settings))
    valid = valid_users(clean_users(parts[0].unionByName(parts[1]), keep_envelope=True))
    for shape in (DAILY, HOURLY):
        assert bag(current_gold(gold_log(spark, settings, shape), shape)) == bag(country_stats(valid, shape))


def test_only_touched_windows_are_logged(spark, users, settings):
    for day in (0, 1):
        send(users({"kafka_timestamp": T0 + dt.timedelta(days=day), "offset": day}), settings)
        finish(jobs.gold_query(cleaned_stream(spark, settings), DAILY, settings))
    log = gold_log(spark, settings, DAILY)
    assert sorted((r.batch_id, r.event_date) for r in log.collect()) == [(0, "2024-01-02"), (1, "2024-01-03")]


def test_a_replayed_batch_changes_nothing_downstream(spark, users, settings):
    raw = some_users(users, 200, 21)
    send(raw, settings)
    cleaned = clean_users(raw, keep_envelope=True)

    def run():
        for layers in (("bronze", "cleaned"), ("silver", "dlq", "latest", "daily")):
            for query in jobs.run_layers(spark, settings, layers):
                finish(query)

    run()
    # The batches of the followed tables lose their commits and are written again.
    for name in ("bronze_writer", jobs.CLEANED):
        remove_folder(spark, f"{settings.checkpoint_root}/{name}/commits")
    run()

    def count(name):
        return read_table(spark, jobs.table_name(settings, name)).count()

    assert count(jobs.CLEANED) == 200 and count("bronze_users") == 200
    assert count("invalid_users_dlq") == invalid_users(cleaned).count()
    assert count("silver_users") + (200 - count("silver_users")) == 200
    expected = country_stats(valid_users(cleaned), DAILY)
    assert bag(current_gold(gold_log(spark, settings, DAILY), DAILY)) == bag(expected)


def test_layers_with_an_outward_format(spark, users, settings):
    send(some_users(users, 50, 22), settings)
    outward = replace(settings, outward_format="noop", outward_root="project.dataset")
    for layers in (("bronze", "cleaned"), ("silver", "bronze_copy", "dlq", "latest", "gold")):
        for query in jobs.run_layers(spark, outward, layers):
            finish(query)
            assert query.exception() is None
    assert jobs.outward(outward, "t").name == "project.dataset.t"


def test_layers_check_the_session(spark, settings, zone):
    zone("Asia/Tokyo")
    with pytest.raises(ValueError, match="UTC"):
        jobs.run_layers(spark, settings, [])
    zone("UTC")
    with pytest.raises(ValueError, match="table_root"):
        jobs.run_layers(spark, replace(settings, table_root=None), ["silver"])


def test_await_any_returns_when_a_query_ends(spark, users, settings):
    spark.streams.resetTerminated()
    send(users({}), settings)
    query = jobs.run_layers(spark, settings, ["bronze"])[0]
    jobs.await_any(spark)
    assert not query.isActive


def test_derived_rows_are_published_once(spark, users, settings, tmp_path):
    send(users({}, {"offset": 1}), settings)
    topic = str(tmp_path / "derived")

    def run():
        finish(jobs.publish_query(cleaned_stream(spark, settings), "cleaned_topic", topic, settings))

    run()
    remove_folder(spark, f"{settings.checkpoint_root}/cleaned_topic/commits")
    run()
    back = replace(settings, topic=topic)
    finish(jobs.start(stream_messages(spark, back), "back", jobs.table_writer(jobs.target(settings, "back")), settings))
    rows = read_table(spark, jobs.table_name(settings, "back")).collect()
    assert len(rows) == 2 and b'"user_key":"1"' in bytes(rows[0]["value"])


def test_approximate_stream_has_exact_counts_and_close_users(spark, users, settings):
    raw = some_users(users, 200, 3)
    send(raw, settings)
    finish(jobs.gold_query(cleaned_stream(spark, settings), DAILY, settings, "approx"))
    got = current_gold(gold_log(spark, settings, DAILY), DAILY)
    expected = country_stats(valid_users(clean_users(raw, keep_envelope=True)), DAILY)
    assert bag(got.drop("unique_users")) == bag(expected.drop("unique_users"))
    # So few users are counted without error.
    assert bag(got) == bag(expected)


def test_closed_windows_are_final_and_exact(spark, users, settings):
    settings = replace(settings, watermark="1 hour")
    raw = some_users(users, 300, 5, hours=96)
    send(raw, settings)
    finish(jobs.gold_query(cleaned_stream(spark, settings), DAILY, settings, "closed"))
    got = bag(gold_log(spark, settings, DAILY).drop("batch_id"))
    expected = bag(country_stats(valid_users(clean_users(raw, keep_envelope=True)), DAILY))
    assert set(got) < set(expected)
    last = max(r[-2] for r in expected)
    assert {r for r in expected if r[-2] < last} == set(got)


def test_closed_needs_a_watermark_and_a_known_way(spark, settings, users):
    send(users({}), settings)
    stream = valid_users(cleaned_stream(spark, settings))
    with pytest.raises(ValueError):
        stream_country_stats(stream, DAILY, "closed")
    with pytest.raises(ValueError):
        stream_country_stats(stream, DAILY, "guess")


def test_late_rows_count_without_a_watermark_and_are_dropped_with_one(spark, users, settings, tmp_path):
    def run(settings):
        for at, offset in ((T0 + dt.timedelta(days=9), 0), (T0, 1)):
            send(users({"kafka_timestamp": at, "offset": offset}), settings)
            finish(jobs.gold_query(cleaned_stream(spark, settings), DAILY, settings))
        return {r.event_date for r in gold_log(spark, settings, DAILY).collect()}

    def under(name, watermark):
        base = tmp_path / name
        return replace(
            settings, topic=str(base / "topic"), table_root=str(base / "t"),
            checkpoint_root=str(base / "c"), watermark=watermark,
        )

    assert run(under("all", None)) == {"2024-01-02", "2024-01-11"}
    assert run(under("bound", "1 hour")) == {"2024-01-11"}


def test_latest_users_stream_equals_batch(spark, users, settings):
    parts = [some_users(users, 120, seed, first_offset=1000 * seed) for seed in range(2)]
    for raw in parts:
        send(raw, settings)
        finish(jobs.latest_query(cleaned_stream(spark, settings), settings))
    log = read_table(spark, jobs.table_name(settings, "valid_users_table"))
    newest = current_latest_users(log)
    expected = latest_users(clean_users(inputs.as_instants(parts[0].unionByName(parts[1])), keep_envelope=True))
    assert bag(newest) == bag(expected)


def test_all_layers_from_one_topic(spark, users, settings):
    raw = some_users(users, 200, 11)
    send(raw, settings)
    order = (("bronze", "cleaned"), ("silver", "dlq", "latest", "daily", "hourly"))
    for layers in order:
        queries = jobs.run_layers(spark, settings, layers)
        assert len({q.name for q in queries}) == len(layers)
        for query in queries:
            finish(query)
    assert list_streams(spark) == []

    def table(name, schema=None):
        return read_table(spark, jobs.table_name(settings, name), schema=schema)

    assert table("bronze_users", BRONZE_SCHEMA).count() == 200
    kept, rejected = table("silver_users", SILVER_SCHEMA), table("silver_quarantine", SILVER_SCHEMA)
    assert kept.count() + rejected.count() == 200
    cleaned = clean_users(raw, keep_envelope=True)
    assert table("invalid_users_dlq").count() == invalid_users(cleaned).count()
    for shape in (DAILY, HOURLY):
        expected = country_stats(valid_users(cleaned), shape)
        assert bag(current_gold(table(shape.name), shape)) == bag(expected)


def test_layers_started_before_any_data_keep_their_columns(spark, users, settings):
    import os

    os.makedirs(settings.topic)
    ticking = replace(settings, trigger={"processingTime": "1 second"})
    queries = jobs.run_layers(spark, ticking, ["bronze", "cleaned", "silver", "dlq"])
    try:
        for offset in (0, 1):
            change = {"age": None, "email": None} if offset else {}
            send(users({"offset": offset, **change}), settings)
            for query in queries:
                query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()

    def rows(name, schema=None):
        return read_table(spark, jobs.table_name(settings, name), schema=schema)

    silver = rows("silver_users", SILVER_SCHEMA).unionByName(rows("silver_quarantine", SILVER_SCHEMA))
    assert sorted((r.offset, r.event_date, r.batch_id, r.uuid) for r in silver.collect()) == [
        (0, "2024-01-02", "0", "u-1"), (1, "2024-01-02", "1", "u-1"),
    ]
    dead = rows("invalid_users_dlq").select("user_key", "data_quality_status", "processed_at", "batch_id")
    assert [r.data_quality_status for r in dead.collect()] == ["INVALID"]


def test_restart_reads_only_new_messages(spark, users, settings):
    for offset in range(3):
        send(users({"offset": offset}), settings)
        decoded = decode_messages(stream_messages(spark, settings))
        finish(jobs.bronze_query(decoded, settings))
        finish(jobs.bronze_query(decoded, settings))
    bronze = read_table(spark, f"{settings.table_root}/bronze_users", schema=BRONZE_SCHEMA)
    assert sorted((r.offset, r.batch_id) for r in bronze.collect()) == [(0, "0"), (1, "1"), (2, "2")]


def test_table_stream_is_throttled(spark, users, settings, tmp_path):
    path = str(tmp_path / "files")
    for offset in range(5):
        users({"offset": offset}).coalesce(1).write.mode("append").parquet(path)
    seen = []
    stream = stream_table(spark, path, users({}).schema, max_files=2)
    finish(jobs.start(stream, "throttled", lambda df, _: seen.append(df.count()), settings))
    assert seen == [2, 2, 1]


def test_a_failed_write_fails_the_batch_and_is_retried(spark, users, settings):
    send(users({}, {}), settings)
    decoded = decode_messages(stream_messages(spark, settings))
    write = jobs.table_writer(jobs.target(settings, "t"))

    def broken(df, batch_id):
        write(df, batch_id)
        raise RuntimeError("target went away")

    with pytest.raises(Exception, match="target went away"):
        finish(jobs.start(decoded, "retry", broken, settings))
    finish(jobs.start(decoded, "retry", write, settings))
    assert spark.read.parquet(jobs.table_name(settings, "t")).count() == 2


def test_gold_messages_are_loaded(spark, users, settings, capsys):
    stats = country_stats(valid_users(clean_users(users({}), keep_envelope=True)), DAILY)
    encode_gold(stats).select(F.col("value").cast("binary").alias("value")).write.parquet(settings.topic)
    finish(jobs.gold_loader(stream_messages(spark, settings, starting="earliest"), DAILY, settings, sample=3))
    row = read_table(spark, jobs.table_name(settings, f"{DAILY.name}_loader")).first()
    assert (row.COUNTRY_CODE, row.TOTAL_USERS, row.source) == ("TH", 1, "ksqldb-gold")
    assert "TH" in capsys.readouterr().out


def test_trigger_can_be_a_clock(spark, users, settings):
    send(users({}), settings)
    ticking = replace(settings, trigger={"processingTime": "1 second"})
    query = jobs.run_layers(spark, ticking, ["bronze"])[0]
    try:
        assert query.name == "bronze_writer" and list_streams(spark) == ["bronze_writer"]
        query.processAllAvailable()
    finally:
        query.stop()
    assert read_table(spark, f"{settings.table_root}/bronze_users", schema=BRONZE_SCHEMA).count() == 1


def test_a_source_format_without_its_connector_says_so(spark, settings):
    with pytest.raises(AnalysisException):
        stream_messages(spark, replace(settings, message_format="kafka", bootstrap="broker:9092"))
