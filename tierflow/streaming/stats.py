"""Gold statistics as stateful streaming aggregates. Exact statistics that emit
every change are in :mod:`tierflow.streaming.gold`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.operators.gold import GoldShape, shaped, stats_from_rollup, user_rollup

#: Output mode of each way to count distinct users.
OUTPUT_MODES = {"approx": "update", "closed": "append"}


def stream_country_stats(
    users: DataFrame,
    shape: GoldShape,
    distinct: str = "approx",
    watermark: str | None = None,
) -> DataFrame:
    """Statistics of valid users (a stream with envelope columns).

    ``distinct`` picks how users are counted:

    * ``approx`` - every change is emitted; the count is a sketch of fixed size.
    * ``closed`` - exact, one final row per window once the watermark passes it.

    ``watermark`` bounds lateness and lets state be dropped; without one every
    late row counts and state is kept for ever. ``closed`` needs it.
    """
    users = _bounded(users, watermark)
    if distinct == "approx":
        return _approx(users, shape)
    if distinct == "closed":
        if watermark is None:
            raise ValueError("closed windows need a watermark")
        return stats_from_rollup(user_rollup(users, shape.size), shape)
    raise ValueError(f"distinct is one of {sorted(OUTPUT_MODES)}, not {distinct!r}")


def _bounded(users: DataFrame, watermark: str | None) -> DataFrame:
    return users if watermark is None else users.withWatermark("kafka_timestamp", watermark)


def _approx(users: DataFrame, shape: GoldShape) -> DataFrame:
    windowed = users.withColumn("window", F.window("kafka_timestamp", shape.size))
    stats = windowed.groupBy("window", "country_code").agg(
        F.count(F.lit(1)).alias(shape.rows),
        F.approx_count_distinct("user_key").alias(shape.users),
        F.round(F.avg("age_validated"), 1).alias(shape.avg_age),
        F.min("age_validated").alias("min_age"),
        F.max("age_validated").alias("max_age"),
        F.max("processed_at").alias("last_updated"),
    )
    return shaped(stats, shape)
