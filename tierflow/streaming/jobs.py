"""Layer queries: what each reads, writes and where it checkpoints."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, LongType, StructField, StructType

from tierflow.operators.bronze import INGEST_DATE
from tierflow.operators.gold import DAILY, HOURLY, GoldShape, load_gold
from tierflow.operators.latest import latest_users
from tierflow.operators.log import newest_versions
from tierflow.operators.messages import MALFORMED, decode_messages, encode_gold, encode_messages
from tierflow.operators.quality import score_quality
from tierflow.operators.silver import (
    ENVELOPE,
    INPUT_FIELDS,
    clean_users,
    invalid_users,
    valid_users,
)
from tierflow.operators.unique import RECORD_HASH, unique_records
from tierflow.schemas import BRONZE_SCHEMA, CLEANED_SCHEMA
from tierflow.session import check_session, shared_dir, state_on_disk
from tierflow.settings import Settings
from tierflow.sinks.commits import CommitLog, Files, TableInUse, Writer, writing_as
from tierflow.sinks.merging import FAN, LARGE, merge_batches
from tierflow.sinks.messages import send_messages
from tierflow.sinks.tables import Target
from tierflow.sources.feeds import Feed
from tierflow.sources.messages import stream_messages
from tierflow.sources.tables import read_table
from tierflow.streaming.gold import gold_writer
from tierflow.streaming.latest import BUCKET, latest_writer
from tierflow.streaming.stats import OUTPUT_MODES, stream_country_stats
from tierflow.streaming.writers import (
    LOAD_ID,
    BatchWriter,
    bronze_writer,
    silver_writer,
    split_writer,
    table_writer,
)

#: Tables that later layers follow: their schema, and what partitions them below
#: the batch id. Gold and dead letters each read their own half of the cleaned rows.
BRONZE, CLEANED = "bronze_users", "cleaned_users_stream"
FOLLOWED = {
    BRONZE: (BRONZE_SCHEMA, ("event_date",)),
    CLEANED: (CLEANED_SCHEMA, ("data_quality_status",)),
}


def _named(root: str | None, name: str, fmt: str) -> str:
    if not root:
        raise ValueError("set table_root to a folder that all executors share")
    return f"{root}{'/' if Target(name, fmt).is_files else '.'}{name}"


def table_name(settings: Settings, name: str) -> str:
    return _named(settings.table_root, name, settings.table_format)


def target(settings: Settings, name: str, *partition_by: str) -> Target:
    return Target(
        table_name(settings, name),
        settings.table_format,
        settings.table_options,
        partition_by,
    )


def outward(settings: Settings, name: str, *partition_by: str) -> Target:
    """A table that nothing here follows: in the warehouse, if one is set."""
    if settings.outward_format is None:
        return target(settings, name, *partition_by)
    where = _named(settings.outward_root or settings.table_root, name, settings.outward_format)
    return Target(where, settings.outward_format, settings.outward_options, partition_by)


def start(
    rows: DataFrame | Feed, name: str, write: BatchWriter, settings: Settings, mode: str = "append"
) -> StreamingQuery:
    """Start one named query with a checkpoint folder of its own.

    Restarting under the same name resumes. A new checkpoint counts batches from 0
    again: ``Settings.takeover`` says what happens to a table that has some already. A
    query that follows a table by a feed goes on where its own tables end, whatever
    its checkpoint.
    """
    spark = rows.spark if isinstance(rows, Feed) else rows.sparkSession
    root = (settings.checkpoint_root or f"{shared_dir(spark)}/streams").rstrip("/")
    known, identity = threading.Event(), {}

    def run(df: DataFrame, batch_id: int) -> None:
        known.wait()
        with writing_as(Writer(identity["id"], settings.takeover)):
            write(df, batch_id)

    def drain(_: DataFrame, __: int) -> None:
        follow_up(rows, name, write, settings, root)

    stream, each = (rows.signals(), drain) if isinstance(rows, Feed) else (rows, run)
    writer = stream.writeStream.queryName(name).outputMode(mode).foreachBatch(each)
    writer = writer.option("checkpointLocation", f"{root}/{name}")
    query = writer.trigger(**settings.trigger).start()
    identity["id"] = query.id
    known.set()
    return query


def follow_up(feed: Feed, name: str, write: BatchWriter, settings: Settings, root: str) -> None:
    """Hand on all batches of a table that the query has not written yet, under their
    own numbers, some ``max_bytes`` at a time.

    What is written is asked of the query's tables, all of which must have a batch.
    Connectors cannot tell: for them the number is kept beside the checkpoints, and a
    group that was cut off is sent again.
    """
    spark, tables = feed.spark, getattr(write, "tables", ())
    me = Writer(f"{name}-after-{feed.target.name.rsplit('/', 1)[-1]}")
    beside, record = Files(spark, root), f"{name}.followed"
    logs = [CommitLog(spark, table.name) for table in tables if table.has_log]
    whole = bool(logs) and len(logs) == len(tables)
    if whole:
        done = [log.newest() for log in logs]
        for log, newest in zip(logs, done):
            if newest is not None and not log.wrote(me.name):
                raise TableInUse(f"{log.files.root} has batches up to {newest} that {me.name} did not write")
        after = None if None in done else min(done)
    else:
        text = beside.read(record)
        after = int(text) if text else None
    with writing_as(me):
        for group in feed.groups(after, settings.max_bytes):
            write(feed.rows(group), group.last)
            if not whole:
                beside.write(record, str(group.last))


def bronze_query(decoded: DataFrame, settings: Settings) -> StreamingQuery:
    """Bronze rows. If ``decoded`` says which messages are no JSON object, those go to a
    table of their own."""
    writer = bronze_writer(followed(settings, BRONZE))
    if MALFORMED in decoded.columns:
        writer = split_writer(writer, outward(settings, "malformed_messages"))
    if settings.unique_within is not None:
        decoded = unique_records(decoded, settings.unique_within).drop(RECORD_HASH)
    return start(decoded, "bronze_writer", writer, settings)


def bronze_copy(bronze: DataFrame | Feed, settings: Settings) -> StreamingQuery:
    """Bronze rows to the outward tables as well."""
    writer = table_writer(outward(settings, "bronze_users_copy", "event_date"), key=LOAD_ID)
    return start(bronze, "bronze_copy", writer, settings)


def silver_query(bronze: DataFrame | Feed, settings: Settings) -> StreamingQuery:
    writer = silver_writer(
        outward(settings, "silver_users", "event_date"),
        outward(settings, "silver_quarantine", "event_date"),
    )
    return start(bronze.transform(score_quality), "silver_transformer", writer, settings)


def cleaned_query(decoded: DataFrame, settings: Settings) -> StreamingQuery:
    """All cleaned rows as a table that the queries below follow, so each message
    is parsed and cleaned once for all of them."""
    writer = table_writer(target(settings, CLEANED, *FOLLOWED[CLEANED][1]))
    return start(clean_users(decoded, keep_envelope=True), CLEANED, writer, settings)


def dlq_query(cleaned: DataFrame | Feed, settings: Settings) -> StreamingQuery:
    writer = table_writer(outward(settings, "invalid_users_dlq"))
    rejected = cleaned.transform(lambda rows: invalid_users(rows.drop(*ENVELOPE)))
    return start(rejected, "invalid_users_dlq", writer, settings)


def latest_query(cleaned: DataFrame | Feed, settings: Settings) -> StreamingQuery:
    """Update log of the newest values per user. From a feed they are kept in a stored
    table, from a stream of rows in streaming state."""
    output = outward(settings, "valid_users_table")
    if isinstance(cleaned, Feed):
        store = replace(target(settings, "valid_users_store", BUCKET), rebalance=True)
        return start(cleaned, "valid_users_table", latest_writer(store, output), settings)
    return start(latest_users(cleaned), "valid_users_table", table_writer(output), settings, "update")


def gold_query(
    cleaned: DataFrame | Feed,
    shape: GoldShape | Iterable[GoldShape],
    settings: Settings,
    distinct: str = "exact",
    topic: str | None = None,
) -> StreamingQuery:
    """Update log of one gold table (final rows only for ``closed``), or of several
    from one rollup. With ``topic`` the changed rows are published as messages too."""
    valid = cleaned.transform(valid_users)
    if distinct != "exact":
        if isinstance(valid, Feed):
            raise ValueError(f"{distinct} statistics keep streaming state and need a stream of rows")
        stats = stream_country_stats(valid, shape, distinct, settings.watermark)
        return start(stats, shape.name, table_writer(outward(settings, shape.name)), settings, OUTPUT_MODES[distinct])
    shapes = (shape,) if isinstance(shape, GoldShape) else tuple(shape)
    name = shapes[0].name if len(shapes) == 1 else "gold_country_stats"

    def publish(rows: DataFrame, batch_id: int, of: GoldShape) -> None:
        send_messages(encode_gold(rows), settings, topic if len(shapes) == 1 else f"{topic}_{of.name}", batch_id)

    writer = gold_writer(
        target(settings, f"{name}_rollup", "day"),
        [(each, outward(settings, each.name)) for each in shapes],
        settings.watermark,
        publish if topic else None,
    )
    return start(valid, name, writer, settings)


def publish_query(rows: DataFrame, name: str, topic: str, settings: Settings) -> StreamingQuery:
    """A derived stream as keyed messages, for consumers outside."""

    def write(df: DataFrame, batch_id: int) -> None:
        send_messages(encode_messages(df), settings, topic, batch_id)

    return start(rows, name, write, settings)


def gold_loader(
    envelopes: DataFrame, shape: GoldShape, settings: Settings, sample: int = 0
) -> StreamingQuery:
    """Gold messages to a warehouse table."""
    name = f"{shape.name}_loader"
    writer = table_writer(outward(settings, name), sample=sample)
    return start(load_gold(envelopes, shape), name, writer, settings)


def _layout(name: str) -> tuple[StructType, tuple[str, ...]]:
    """Stored schema and folder levels of a followed table."""
    schema, below = FOLLOWED[name]
    if "batch_id" not in schema.fieldNames():
        schema = StructType([*schema.fields, StructField("batch_id", LongType())])
    above = (INGEST_DATE,) if name == BRONZE else ()
    schema = StructType([*schema.fields, *(StructField(level, DateType()) for level in above)])
    return schema, (*above, "batch_id", *below)


def follow(spark: SparkSession, settings: Settings, name: str) -> Feed:
    """The rows another query adds to a table, as they come; the table may be empty."""
    schema, _ = _layout(name)
    return Feed(spark, followed(settings, name), schema, tuple(FOLLOWED[name][0].fieldNames()))


def followed(settings: Settings, name: str) -> Target:
    table = target(settings, name, *FOLLOWED[name][1])
    return replace(table, stamp=INGEST_DATE) if name == BRONZE else table


def maintain(spark: SparkSession, settings: Settings, keep: int = 1, fan: int = FAN, large: int = LARGE) -> dict[str, int]:
    """Merge old batches of the followed tables and of the update logs that lie in files;
    returns the merges per table. A log keeps the newest version of each key.

    May run beside the queries: what they read and write next is never touched.
    """
    done = {}
    for name in FOLLOWED:
        if CommitLog(spark, table_name(settings, name)).exists():
            done[name] = merge_batches(spark, followed(settings, name), _layout(name)[0], keep, fan=fan, large=large)
    for name, keys, order in LOGS:
        table = outward(settings, name)
        if table.has_log and CommitLog(spark, table.name).exists():
            schema = read_table(spark, table.name, table.fmt, table.options).schema
            combine = partial(newest_versions, keys=keys, order=order)
            done[name] = merge_batches(spark, table, schema, keep, combine, fan=fan)
    return done


#: Update logs: their keys, and what orders the versions of one batch.
LOGS = (
    ("valid_users_table", ("user_key",), ()),
    (DAILY.name, DAILY.keys, ("last_updated",)),
    (HOURLY.name, HOURLY.keys, ("last_updated",)),
)

LAYERS = ("bronze", "cleaned", "silver", "dlq", "latest", "daily", "hourly")


def run_layers(
    spark: SparkSession, settings: Settings, layers: Iterable[str] = LAYERS
) -> list[StreamingQuery]:
    """Start the chosen layer queries, see :func:`layer_starters`."""
    return [start_layer() for start_layer in layer_starters(spark, settings, layers).values()]


def layer_starters(
    spark: SparkSession, settings: Settings, layers: Iterable[str] = LAYERS
) -> dict[str, Callable[[], StreamingQuery]]:
    """What starts each of the chosen layer queries, or starts it again from its own
    checkpoint; ``supervise`` takes these.

    Two queries read the topic: bronze keeps all user fields, the cleaned stream
    asks the parser only for what the strict policy uses. Silver follows the
    bronze table, the others follow the cleaned table. ``gold`` builds both gold
    tables from one rollup, instead of ``daily`` and ``hourly``.
    """

    def bronze() -> StreamingQuery:
        messages = stream_messages(spark, settings)
        with state_on_disk(spark):
            return bronze_query(decode_messages(messages, malformed=settings.split_malformed), settings)

    def cleaned() -> StreamingQuery:
        decoded = decode_messages(stream_messages(spark, settings, starting="earliest"), INPUT_FIELDS)
        if settings.unique_within is not None:
            decoded = unique_records(decoded, settings.unique_within).drop(RECORD_HASH)
        with state_on_disk(spark):
            return cleaned_query(decoded, settings)

    check_session(spark)
    sources = {"silver": BRONZE, "bronze_copy": BRONZE}
    sources |= dict.fromkeys(("dlq", "latest", "daily", "hourly", "gold"), CLEANED)
    chosen = list(layers)
    rows = {layer: follow(spark, settings, sources[layer]) for layer in chosen if layer in sources}
    starters = {
        "bronze": bronze,
        "cleaned": cleaned,
        "silver": lambda: silver_query(rows["silver"], settings),
        "dlq": lambda: dlq_query(rows["dlq"], settings),
        "latest": lambda: latest_query(rows["latest"], settings),
        "bronze_copy": lambda: bronze_copy(rows["bronze_copy"], settings),
        "gold": lambda: gold_query(rows["gold"], (DAILY, HOURLY), settings),
        "daily": lambda: gold_query(rows["daily"], DAILY, settings),
        "hourly": lambda: gold_query(rows["hourly"], HOURLY, settings),
    }
    return {layer: starters[layer] for layer in chosen}


def await_any(spark: SparkSession) -> None:
    spark.streams.awaitAnyTermination()
