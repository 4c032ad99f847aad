"""Batch runs over stored tables. Each run names its own part of the target, so
running it again replaces that part and adds nothing twice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.operators.bronze import recent
from tierflow.operators.gold import (
    DAILY,
    HOURLY,
    coarsen_rollup,
    stats_from_rollup,
    user_rollup,
)
from tierflow.operators.quality import score_quality
from tierflow.operators.silver import valid_users
from tierflow.schemas import BRONZE_SCHEMA
from tierflow.session import work_dir
from tierflow.settings import Settings
from tierflow.sinks.tables import Target, remove_folder, replace_table, write_batch
from tierflow.sources.tables import read_table
from tierflow.streaming.jobs import table_name
from tierflow.streaming.writers import LOAD_ID


def silver_batch(spark: SparkSession, settings: Settings, as_of: str, span: str = "1 HOURS") -> None:
    """Score the bronze rows ingested in the ``span`` that ends at ``as_of``.

    The span is open at its end, so adjoining runs share no row. The instant itself
    names the run: other spellings of one time are the same run, and running it again
    replaces all of its rows, also by none. Complete and quarantined rows go to their
    own folders, ``is_complete=true`` and ``is_complete=false``, in one pass.
    """
    name = table_name(settings, "bronze_users")
    bronze = read_table(spark, name, settings.table_format, settings.table_options, BRONZE_SCHEMA)
    load_id = spark.range(1).select(F.unix_micros(F.lit(as_of).try_cast("timestamp"))).first()[0]
    if load_id is None:
        raise ValueError(f"{as_of!r} is no time")
    chosen = recent(bronze, F.timestamp_micros(F.lit(load_id)), span, until=True)
    target = Target(
        table_name(settings, "silver_batch"),
        settings.table_format,
        settings.table_options,
        ("is_complete", "event_date"),
        rebalance=True,
    )
    write_batch(score_quality(chosen), target, load_id, key=LOAD_ID, replace=True)


def gold_batch(
    spark: SparkSession, cleaned: DataFrame, settings: Settings, shapes: Sequence = (DAILY, HOURLY)
) -> None:
    """Build all gold tables from one pass over the cleaned rows.

    The hourly per-user rollup is written once to the shared folder and each
    table is computed from it, the daily one by adding hours up.
    """
    path = f"{work_dir(spark, 'user_rollup')}/{HOURLY.name}"
    user_rollup(valid_users(cleaned), HOURLY.size).write.parquet(path)
    hourly = spark.read.parquet(path)
    for shape in shapes:
        rollup = hourly if shape.size == HOURLY.size else coarsen_rollup(hourly, shape.size)
        target = Target(table_name(settings, shape.name), settings.table_format, settings.table_options)
        replace_table(stats_from_rollup(rollup, shape), target)
    remove_folder(spark, path)
