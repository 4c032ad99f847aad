"""Registered queries: each derives user records from the whole ``events`` table
and applies one operator. Times come out as UTC wall clocks; columns that hold
the moment of processing are left out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.batch import silver_batch
from tierflow.functions.keys import record_hash
from tierflow.functions.times import utc_ntz
from tierflow.operators.bronze import INGEST_DATE, recent, to_bronze
from tierflow.operators.gold import (
    DAILY,
    HOURLY,
    GoldShape,
    coarsen_rollup,
    country_stats,
    current_gold,
    load_gold,
    stats_from_rollup,
    user_rollup,
)
from tierflow.operators.latest import current_latest_users, latest_users
from tierflow.operators.log import compact_log
from tierflow.operators.messages import (
    decode_messages,
    encode_gold,
    encode_messages,
    split_malformed,
)
from tierflow.operators.quality import (
    flag_quality,
    quality_summary,
    score_quality,
    split_by_quality,
)
from tierflow.operators.reconcile import missing_keys, reconcile_counts
from tierflow.operators.records import normalise_records
from tierflow.operators.silver import INPUT_FIELDS, clean_users, invalid_users, valid_users
from tierflow.operators.unique import unique_records
from tierflow.plans import inputs
from tierflow.schemas import BRONZE_SCHEMA, SILVER_SCHEMA, USER_SCHEMA
from tierflow.session import work_dir
from tierflow.settings import Settings
from tierflow.sinks.messages import send_records
from tierflow.sinks.tables import append_table, remove_folder
from tierflow.sources.messages import stream_messages
from tierflow.sources.records import read_records
from tierflow.sources.relations import relation_sizes
from tierflow.sources.tables import read_table
from tierflow.streaming import jobs
from tierflow.streaming.writers import table_writer

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.raw_users(inputs.events(spark, sf_dir))


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_users(_raw(spark, sf_dir), keep_envelope=True)


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_users(_cleaned(spark, sf_dir))


def _plain(df: DataFrame, *names: str) -> DataFrame:
    """Session-zone timestamps as their wall clock."""
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


# Records and messages


@query("normalise_records")
def _normalised_records(spark, sf_dir):
    records = inputs.api_records(inputs.events(spark, sf_dir))
    return normalise_records(records).drop("fetched_at")


@query("message_key")
def _message_key(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return encode_messages(raw, "kafka_timestamp", "offset", "partition").select("offset", "key")


@query("encode_messages")
def _encoded_messages(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return encode_messages(raw, "kafka_timestamp", "offset", "partition").select("key", "value")


@query("decode_envelope")
def _decode_envelope(spark, sf_dir):
    return decode_messages(inputs.envelopes(_raw(spark, sf_dir)))


@query("malformed_messages")
def _malformed_messages(spark, sf_dir):
    """What is set aside of messages of which some are cut off, no JSON or without text."""
    sent = inputs.faulty(inputs.envelopes(_raw(spark, sf_dir)))
    return split_malformed(decode_messages(sent, malformed=True))[1]


@query("unique_records")
def _unique_records(spark, sf_dir):
    """The first message of each record, all records having been sent twice."""
    raw = _raw(spark, sf_dir)
    again = raw.withColumn("offset", F.col("offset") + 10_000_000)
    found = unique_records(raw.unionByName(again), "1 hour")
    return found.select("record_hash", "offset", "user_id", "uuid", "fetched_at")


# Bronze


@query("bronze_enrich")
def _bronze_enrich(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    bronze = to_bronze(raw, batch_id=0, ingested_at=F.col("kafka_timestamp"))
    return bronze.drop("source_file")


@query("lookback_window")
def _lookback_window(spark, sf_dir):
    bronze = to_bronze(_raw(spark, sf_dir), 0, ingested_at=F.col("kafka_timestamp"))
    as_of = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    return recent(bronze, as_of).select("offset", "user_id", "ingested_at")


# Silver, scored policy


@query("dq_flags")
def _dq_flags(spark, sf_dir):
    flagged = flag_quality(_raw(spark, sf_dir))
    return flagged.select("offset", "is_valid_email", "is_valid_age", "is_valid_country")


@query("dq_score")
def _dq_score(spark, sf_dir):
    scored = score_quality(_raw(spark, sf_dir))
    return scored.select("offset", "data_quality_score", "is_complete")


@query("dq_summary")
def _dq_summary(spark, sf_dir):
    return quality_summary(score_quality(_raw(spark, sf_dir)))


def _scored_output(rows: DataFrame) -> DataFrame:
    return rows.drop("processed_at")


@query("silver_complete")
def _silver_complete(spark, sf_dir):
    return _scored_output(split_by_quality(score_quality(_raw(spark, sf_dir)))[0])


@query("quarantine_rows")
def _quarantine_rows(spark, sf_dir):
    return _scored_output(split_by_quality(score_quality(_raw(spark, sf_dir)))[1])


@query("record_hash")
def _record_hashes(spark, sf_dir):
    return _raw(spark, sf_dir).select("offset", record_hash().alias("record_hash"))


# Silver, strict policy


@query("clean_users")
def _cleaned_users(spark, sf_dir):
    return _plain(clean_users(_raw(spark, sf_dir)), "fetched_timestamp")


def _cleaned_columns(*names: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = _cleaned(spark, sf_dir).select("offset", *names)
        return _plain(found, *(n for n in names if n == "fetched_timestamp"))

    return run


CLEANED_VIEWS = {
    "record_key": ("user_key",),
    "clean_text": ("name", "email_normalized"),
    "age_validated": ("age_validated",),
    "canonical_country": ("country_code",),
    "fetched_timestamp": ("fetched_timestamp",),
    "strict_status": ("data_quality_status",),
}
QUERIES.update({name: _cleaned_columns(*columns) for name, columns in CLEANED_VIEWS.items()})


@query("valid_users_stream")
def _valid_users_stream(spark, sf_dir):
    return _plain(valid_users(clean_users(_raw(spark, sf_dir))), "fetched_timestamp")


@query("invalid_dlq")
def _invalid_dlq(spark, sf_dir):
    return _plain(invalid_users(clean_users(_raw(spark, sf_dir))), "fetched_timestamp")


@query("latest_users")
def _latest_users_table(spark, sf_dir):
    return _plain(latest_users(_cleaned(spark, sf_dir)), "last_seen")


@query("latest_users_with_nulls")
def _latest_users_with_nulls(spark, sf_dir):
    return _plain(latest_users(_cleaned(spark, sf_dir), ignore_nulls=False), "last_seen")


# Gold


@query("daily_country_stats")
def _daily_country_stats(spark, sf_dir):
    return country_stats(_valid(spark, sf_dir), DAILY)


@query("hourly_country_stats")
def _hourly_country_stats(spark, sf_dir):
    return country_stats(_valid(spark, sf_dir), HOURLY)


@query("daily_from_hourly_rollup")
def _daily_from_hourly_rollup(spark, sf_dir):
    hourly = user_rollup(_valid(spark, sf_dir), HOURLY.size)
    return stats_from_rollup(coarsen_rollup(hourly, DAILY.size), DAILY)


def _loaded(spark: SparkSession, sf_dir: str, shape: GoldShape) -> DataFrame:
    messages = encode_gold(country_stats(_valid(spark, sf_dir), shape))
    loaded = load_gold(messages, shape).drop("ingested_at")
    return loaded.withColumn("last_updated_timestamp", utc_ntz(F.col("last_updated_timestamp")))


@query("load_gold")
def _load_gold_daily(spark, sf_dir):
    return _loaded(spark, sf_dir, DAILY)


@query("load_gold_hourly")
def _load_gold_hourly(spark, sf_dir):
    return _loaded(spark, sf_dir, HOURLY)


def _changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily statistics as three batches would log them, batch n adding the rows
    of message partition n: after each batch the groups it touched, as they then
    stand. Each row counts in its own batch and the later ones."""
    seen = _valid(spark, sf_dir).select(
        "*", F.explode(F.sequence("partition", F.lit(2))).alias("batch_id")
    )
    keys = ("batch_id", F.window("kafka_timestamp", "1 day"), "country_code")
    stats = seen.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_users"),
        F.countDistinct("user_key").alias("unique_users"),
        F.max("processed_at").alias("last_updated"),
        F.max("partition").alias("newest"),
    )
    touched = stats.filter(F.col("newest") == F.col("batch_id"))
    return touched.select(
        "country_code", "total_users", "unique_users",
        DAILY.bucket_label(touched, "window.start").alias("event_date"),
        "last_updated", "batch_id",
    )


@query("gold_changelog")
def _gold_changelog(spark, sf_dir):
    return _changelog(spark, sf_dir)


@query("current_gold")
def _current_gold_daily(spark, sf_dir):
    return current_gold(_changelog(spark, sf_dir), DAILY)


# Reconciliation: all records against those that pass the strict policy


def _delivered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    raw = _raw(spark, sf_dir)
    return raw, valid_users(clean_users(raw))


@query("reconcile_counts")
def _reconciled_counts(spark, sf_dir):
    return reconcile_counts(*_delivered(spark, sf_dir))


@query("missing_keys")
def _undelivered_keys(spark, sf_dir):
    raw, valid = _delivered(spark, sf_dir)
    expected = raw.select(F.coalesce("user_id", "uuid").alias("user_key"))
    return missing_keys(expected, valid.select("user_key"), "user_key")


@query("relation_sizes")
def _relation_sizes(spark, sf_dir):
    """Rows per named relation."""
    return relation_sizes(_raw(spark, sf_dir))


@query("reconcile_delivered")
def _reconciled_delivery(spark, sf_dir):
    """Every record becomes a message and comes out again."""
    raw = _raw(spark, sf_dir)
    return reconcile_counts(raw, decode_messages(inputs.envelopes(raw)))


@query("record_files")
def _record_files(spark, sf_dir):
    """Response bodies as JSON files of up to a thousand records, read back."""
    path = work_dir(spark, "bodies")
    records = inputs.api_records(inputs.events(spark, sf_dir), body="event_id div 1000")
    fields = F.struct(*(c for c in records.columns if c != "body"))
    listed = records.groupBy("body").agg(F.to_json(F.collect_list(fields)).alias("value"))
    listed.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return read_records(spark, path).drop("fetched_at")


@query("sent_messages")
def _sent_messages(spark, sf_dir):
    """Records sent to a topic and read back from it as a stream."""
    settings = _fresh(spark, "topic")
    settings = replace(settings, message_format="parquet", topic=f"{settings.table_root}/topic")
    send_records(_raw(spark, sf_dir).select(*USER_SCHEMA.fieldNames()), settings)
    decoded = decode_messages(stream_messages(spark, settings, starting="earliest"))
    name = "read_back"
    _finished(jobs.start(decoded, name, table_writer(jobs.target(settings, name)), settings))
    return read_table(spark, jobs.table_name(settings, name)).select(*USER_SCHEMA.fieldNames())


@query("silver_batch_runs")
def _silver_batch_runs(spark, sf_dir):
    """Two adjoining spans, the first of them run twice."""
    settings = _fresh(spark, "silver_batch")
    raw = inputs.as_instants(_raw(spark, sf_dir))
    bronze = to_bronze(raw, 0, ingested_at=F.col("kafka_timestamp"))
    stamped = bronze.withColumn(INGEST_DATE, F.to_date("ingested_at"))
    append_table(stamped, jobs.target(settings, jobs.BRONZE, INGEST_DATE))
    for as_of in ("2024-01-15 12:00:00", "2024-01-16T12:00:00Z", "2024-01-15T12:00:00.000+00:00"):
        silver_batch(spark, settings, as_of, "24 HOURS")
    table = read_table(spark, jobs.table_name(settings, "silver_batch"), schema=SILVER_SCHEMA)
    return table.select("offset", "data_quality_score", "is_complete", "record_hash")


# Streams: run over the whole input until it is used up, then read the tables


def _decoded_stream(spark: SparkSession, sf_dir: str, fields=None) -> DataFrame:
    raw = inputs.as_instants(inputs.raw_users(inputs.stream_events(spark, sf_dir)))
    return decode_messages(inputs.envelopes(raw), fields)


def _cleaned_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_users(_decoded_stream(spark, sf_dir, INPUT_FIELDS), keep_envelope=True)


def _fresh(spark: SparkSession, name: str) -> Settings:
    root = work_dir(spark, name)
    return Settings(
        table_root=f"{root}/tables",
        checkpoint_root=f"{root}/checkpoints",
        trigger={"availableNow": True},
    )


def _finished(query_handle) -> None:
    query_handle.awaitTermination()


def _stream_gold(spark: SparkSession, sf_dir: str, shape: GoldShape) -> DataFrame:
    """Messages to the cleaned table, and gold following that table."""
    settings = _fresh(spark, shape.name)
    _finished(jobs.cleaned_query(_decoded_stream(spark, sf_dir, INPUT_FIELDS), settings))
    cleaned = jobs.follow(spark, settings, jobs.CLEANED)
    _finished(jobs.gold_query(cleaned, shape, settings))
    log = read_table(spark, jobs.table_name(settings, shape.name))
    return current_gold(log, shape)


@query("stream_daily_country_stats")
def _stream_daily_country_stats(spark, sf_dir):
    return _stream_gold(spark, sf_dir, DAILY)


@query("stream_hourly_country_stats")
def _stream_hourly_country_stats(spark, sf_dir):
    return _stream_gold(spark, sf_dir, HOURLY)


@query("stream_gold_both")
def _stream_gold_both(spark, sf_dir):
    """Both gold tables from one rollup; the hourly one."""
    settings = _fresh(spark, "gold")
    _finished(jobs.cleaned_query(_decoded_stream(spark, sf_dir, INPUT_FIELDS), settings))
    cleaned = jobs.follow(spark, settings, jobs.CLEANED)
    _finished(jobs.gold_query(cleaned, (DAILY, HOURLY), settings))
    return current_gold(read_table(spark, jobs.table_name(settings, HOURLY.name)), HOURLY)


@query("stream_replay_gold")
def _stream_replay_gold(spark, sf_dir):
    """The cleaned table and gold after both lost the commit of their batch, so that
    each wrote it a second time."""
    settings = _fresh(spark, "replay")

    def run() -> None:
        _finished(jobs.cleaned_query(_decoded_stream(spark, sf_dir, INPUT_FIELDS), settings))
        _finished(jobs.gold_query(jobs.follow(spark, settings, jobs.CLEANED), DAILY, settings))

    run()
    for name in (jobs.CLEANED, DAILY.name):
        remove_folder(spark, f"{settings.checkpoint_root}/{name}/commits")
    run()
    return current_gold(read_table(spark, jobs.table_name(settings, DAILY.name)), DAILY)


@query("stream_gold_messages")
def _stream_gold_messages(spark, sf_dir):
    """Gold published as messages and loaded from the topic."""
    settings = _fresh(spark, "gold_messages")
    settings = replace(settings, message_format="parquet", topic=f"{settings.table_root}/topic")
    _finished(jobs.cleaned_query(_decoded_stream(spark, sf_dir, INPUT_FIELDS), settings))
    cleaned = jobs.follow(spark, settings, jobs.CLEANED)
    _finished(jobs.gold_query(cleaned, DAILY, settings, topic=settings.topic))
    _finished(jobs.gold_loader(stream_messages(spark, settings, starting="earliest"), DAILY, settings))
    loaded = read_table(spark, jobs.table_name(settings, f"{DAILY.name}_loader")).drop("ingested_at", "batch_id")
    return loaded.withColumn("last_updated_timestamp", utc_ntz(F.col("last_updated_timestamp")))


def _latest_log(spark: SparkSession, sf_dir: str) -> tuple[Settings, DataFrame]:
    settings = _fresh(spark, "valid_users_table")
    _finished(jobs.latest_query(_cleaned_stream(spark, sf_dir), settings))
    return settings, read_table(spark, jobs.table_name(settings, "valid_users_table"))


@query("stream_latest_users")
def _stream_latest_users(spark, sf_dir):
    return _plain(current_latest_users(_latest_log(spark, sf_dir)[1]), "last_seen")


@query("compacted_latest_users")
def _compacted_latest_users(spark, sf_dir):
    settings, log = _latest_log(spark, sf_dir)
    newest = jobs.target(settings, "valid_users_compacted")
    through = log.agg(F.max("batch_id")).first()[0] or 0
    compact_log(log, newest, ["user_key"], through)
    return _plain(current_latest_users(read_table(spark, newest.name)), "last_seen")


@query("stream_dead_letters")
def _stream_dead_letters(spark, sf_dir):
    settings = _fresh(spark, "invalid_users_dlq")
    _finished(jobs.dlq_query(_cleaned_stream(spark, sf_dir), settings))
    log = read_table(spark, jobs.table_name(settings, "invalid_users_dlq")).drop("batch_id")
    return _plain(log, "fetched_timestamp")


def _bronze_table(spark: SparkSession, sf_dir: str, settings: Settings) -> str:
    _finished(jobs.bronze_query(_decoded_stream(spark, sf_dir), settings))
    return jobs.table_name(settings, "bronze_users")


@query("stream_bronze_users")
def _stream_bronze_users(spark, sf_dir):
    settings = _fresh(spark, "bronze_users")
    table = read_table(spark, _bronze_table(spark, sf_dir, settings), schema=BRONZE_SCHEMA)
    kept = table.select(
        *USER_SCHEMA.fieldNames(), "kafka_timestamp", "offset", "partition", "event_date"
    )
    return kept.withColumn("kafka_timestamp", utc_ntz(F.col("kafka_timestamp")))


@query("stream_silver_users")
def _stream_silver_users(spark, sf_dir):
    """Bronze as a stream, scored and split: rows of both tables by score."""
    settings = _fresh(spark, "silver_users")
    _bronze_table(spark, sf_dir, settings)
    bronze = jobs.follow(spark, settings, jobs.BRONZE)
    _finished(jobs.silver_query(bronze, settings))
    kept, rejected = (
        read_table(spark, jobs.table_name(settings, name), schema=SILVER_SCHEMA)
        .select(
            "offset", "event_date", "data_quality_score", "record_hash", F.lit(name).alias("table_name")
        )
        for name in ("silver_users", "silver_quarantine")
    )
    return kept.unionByName(rejected)


# Streams that go on: new checkpoints, late rows, merged batches, repeats


def _messages(
    spark: SparkSession, sf_dir: str, settings: Settings, part: str = "true", files: int | None = None
) -> None:
    """Add the messages of some records to a topic, in a number of even files if one is given."""
    sent = inputs.envelopes(inputs.as_instants(_raw(spark, sf_dir))).filter(part)
    if files is not None:
        sent = sent.repartition(files)
    sent.write.mode("append").format(settings.message_format).save(settings.topic)


def _topic(spark: SparkSession, name: str, **more) -> Settings:
    settings = _fresh(spark, name)
    return replace(settings, message_format="parquet", topic=f"{settings.table_root}/topic", **more)


def _drained(spark: SparkSession, settings: Settings, *layers: str) -> None:
    """Let layers use up what there is, one after another."""
    for start_layer in jobs.layer_starters(spark, settings, layers).values():
        _finished(start_layer())


@query("stream_new_checkpoint")
def _stream_new_checkpoint(spark, sf_dir):
    """Two halves of the messages by queries with checkpoints of their own: the second
    ones go on after the batches of the first."""
    settings = _topic(spark, "checkpoints")
    for half in (0, 1):
        settings = replace(
            settings, topic=f"{settings.table_root}/topic{half}", takeover="continue",
            checkpoint_root=f"{settings.checkpoint_root}{half}",
        )
        _messages(spark, sf_dir, settings, f"offset % 2 = {half}")
        _drained(spark, settings, "cleaned", "daily")
    return current_gold(read_table(spark, jobs.table_name(settings, DAILY.name)), DAILY)


@query("stream_late_rows")
def _stream_late_rows(spark, sf_dir):
    """Gold with a bound on lateness: the second half of the messages comes after the
    first, and its rows count only where their day had not ended a day before the newest."""
    settings = _topic(spark, "late", watermark="1 day")
    for half in (0, 1):
        _messages(spark, sf_dir, settings, f"offset % 2 = {half}")
        _drained(spark, settings, "cleaned", "daily")
    return current_gold(read_table(spark, jobs.table_name(settings, DAILY.name)), DAILY)


def _many_batches(spark: SparkSession, sf_dir: str, name: str, *layers: str) -> Settings:
    """Four batches, a file each, of which old ones are merged half way and at the end."""
    settings = _topic(spark, name, max_bytes=1)
    for half in (0, 1):
        _messages(spark, sf_dir, settings, f"offset % 2 = {half}", files=2)
        _drained(spark, settings, "cleaned", *layers)
        jobs.maintain(spark, settings, fan=2)
    return settings


@query("stream_merged_gold")
def _stream_merged_gold(spark, sf_dir):
    settings = _many_batches(spark, sf_dir, "merged_gold", "daily")
    return current_gold(read_table(spark, jobs.table_name(settings, DAILY.name)), DAILY)


@query("stream_merged_latest_users")
def _stream_merged_latest_users(spark, sf_dir):
    settings = _many_batches(spark, sf_dir, "merged_latest", "latest")
    log = read_table(spark, jobs.table_name(settings, "valid_users_table"))
    return _plain(current_latest_users(log), "last_seen")


@query("stream_unique_records")
def _stream_unique_records(spark, sf_dir):
    """Bronze of messages that are all sent again, before and after a restart."""
    settings = _topic(spark, "unique", unique_within="3650 days")
    for _ in range(2):
        _messages(spark, sf_dir, settings)
        _drained(spark, settings, "bronze")
    bronze = read_table(spark, jobs.table_name(settings, jobs.BRONZE), schema=BRONZE_SCHEMA)
    # A missing field and an empty one give the same hash, so either row may be the one.
    fields = (F.coalesce(name, F.lit("")).alias(name) for name in ("user_id", "uuid", "fetched_at"))
    return bronze.select(record_hash().alias("record_hash"), *fields)


@query("stream_malformed_messages")
def _stream_malformed_messages(spark, sf_dir):
    """Both sides of the split: bronze rows and what was set aside, by offset."""
    settings = _topic(spark, "malformed", split_malformed=True)
    sent = inputs.faulty(inputs.envelopes(inputs.as_instants(_raw(spark, sf_dir))))
    sent.write.parquet(settings.topic)
    _drained(spark, settings, "bronze")
    bronze = read_table(spark, jobs.table_name(settings, jobs.BRONZE), schema=BRONZE_SCHEMA)
    aside = read_table(spark, jobs.table_name(settings, "malformed_messages"))
    return bronze.select("offset", "username", F.lit(None).cast("string").alias("error_type")).unionByName(
        aside.select("offset", F.lit(None).cast("string").alias("username"), "error_type")
    )
