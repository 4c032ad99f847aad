"""Exact gold statistics of a stream without streaming state.

Each micro-batch is reduced to one row per hour, country and user and stored. The
statistics of the windows that it touched are then computed from the stored rows of
those days. Distinct users are exact, late rows count, one rollup serves all
shapes, and what a query knows is a table instead of state that must fit somewhere.

Stored rows of many batches are combined in levels, each some batches wide: what a
micro-batch reads of a day stays near the number of its hours, countries and users,
however many batches there were.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions.times import day_label
from tierflow.operators.gold import (
    HOURLY,
    GoldShape,
    coarsen_rollup,
    combine_rollup,
    stats_from_rollup,
    user_rollup,
)
from tierflow.sinks.commits import Commit, CommitLog
from tierflow.sinks.merging import FAN, merge_batches
from tierflow.sinks.tables import Target, commit_empty, is_published, opened, write_batch
from tierflow.sources.tables import read_entries
from tierflow.streaming.writers import BatchWriter, writes

ROLLUP_SCHEMA = T.StructType(
    [
        T.StructField("hour", T.TimestampType()),
        T.StructField("country_code", T.StringType()),
        T.StructField("user_key", T.StringType()),
        *(T.StructField(name, T.LongType()) for name in ("n", "age_sum", "age_n")),
        *(T.StructField(name, T.IntegerType()) for name in ("age_min", "age_max")),
        T.StructField("updated", T.LongType()),
        T.StructField("day", T.StringType()),
    ]
)

#: What else happens with the rows of one shape that a batch changed.
Publish = Callable[[DataFrame, int, GoldShape], None]

#: Kept with each batch of the rollup: the newest time of all rows so far.
NEWEST = "newest"


def gold_writer(
    rollup: Target,
    outputs: Sequence[tuple[GoldShape, Target]],
    watermark: str | None = None,
    publish: Publish | None = None,
    fan: int = FAN,
) -> BatchWriter:
    """Write the changed rows of each shape for every batch of valid users.

    A batch computes from itself and the batches before it, so a replay gives the
    same rows. ``watermark`` drops rows whose window ended that long before the
    newest row of the earlier batches, which each batch's commit remembers; without
    one every late row counts.
    """

    def write(users: DataFrame, batch_id: int) -> None:
        spark = users.sparkSession
        log = opened(spark, rollup)
        batch = log.claim(batch_id)
        before = log.note(batch).get(NEWEST)
        if watermark is not None and before is not None:
            users = _on_time(users, int(before))
        hours = user_rollup(users, HOURLY.size)
        hours = hours.withColumn("day", day_label(hours, "window.start"))
        hours = hours.select(F.col("window.start").alias("hour"), *hours.columns[1:])

        def newest(folder: str) -> dict[str, int | None]:
            own = spark.read.format(rollup.fmt).options(**rollup.options).schema(ROLLUP_SCHEMA).load(folder)
            found = [time for time in (before, own.agg(F.max("updated")).first()[0]) if time is not None]
            return {NEWEST: max(found, default=None)}

        write_batch(hours, rollup, batch_id, note=newest)
        _write_changed(log, batch, hours, batch_id)
        merge_batches(spark, rollup, ROLLUP_SCHEMA, combine=_combined, fan=fan)

    def _write_changed(log: CommitLog, batch: int, hours: DataFrame, batch_id: int) -> None:
        spark = hours.sparkSession
        if publish is None and all(is_published(spark, target, batch_id) for _, target in outputs):
            return
        single = [e for e in log.entries(batch - 1) if isinstance(e, Commit) and e.batch == batch]
        # A batch that is tried again after its rows were combined reads them from its input.
        mine = _read(spark, single) if single else hours
        # Days of one batch: a handful, and the folders that have to be read.
        days = [row["day"] for row in mine.select("day").distinct().collect()]
        if not days:
            for _, target in outputs:
                commit_empty(spark, target, batch_id)
            return
        window = F.struct(F.col("hour").alias("start")).alias("window")
        entries = [entry for entry in log.entries() if entry.batch <= batch]
        past = _read(spark, entries, days).filter(F.col("day").isin(days))
        for shape, target in outputs:
            stats = stats_from_rollup(coarsen_rollup(past.select(window, "*"), shape.size), shape)
            touched = stats_from_rollup(coarsen_rollup(mine.select(window, "*"), shape.size), shape)
            changed = stats.join(touched.select(*shape.keys), list(shape.keys), "left_semi").select(*stats.columns)
            write_batch(changed, target, batch_id)
            if publish is not None:
                publish(changed, batch_id, shape)

    def _read(spark, entries, days=None) -> DataFrame:
        only = None if days is None else {"day": days}
        return read_entries(spark, rollup.name, entries, rollup.fmt, rollup.options, ROLLUP_SCHEMA, only)

    def _on_time(users: DataFrame, newest: int) -> DataFrame:
        size = max((shape for shape, _ in outputs), key=lambda shape: shape.size == "1 day").size
        bound = F.timestamp_millis(F.lit(newest)) - F.expr(f"INTERVAL {watermark}")
        return users.filter(F.window("kafka_timestamp", size)["end"] > bound)

    return writes(write, *(target for _, target in outputs))


def _combined(rows: DataFrame) -> DataFrame:
    return combine_rollup(rows, "hour", "day")
