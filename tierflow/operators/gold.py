"""Gold: per-country statistics over tumbling windows, and their update log."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierflow.functions.times import day_label, hour_label
from tierflow.operators.log import current_rows
from tierflow.operators.messages import decode_values
from tierflow.schemas import DAILY_MESSAGE_SCHEMA, HOURLY_MESSAGE_SCHEMA

# Fixed value: the source label of loaded gold rows.
GOLD_SOURCE = "ksqldb-gold"


@dataclass(frozen=True)
class GoldShape:
    """Window size and column names of one gold table."""

    name: str
    size: str
    rows: str
    users: str
    avg_age: str
    bucket: str
    bucket_label: Callable[[DataFrame, str], Column]
    age_limits: bool
    messages: StructType

    @property
    def keys(self) -> tuple[str, str]:
        return "country_code", self.bucket


DAILY = GoldShape(
    name="gold_daily_country_stats",
    size="1 day",
    rows="total_users",
    users="unique_users",
    avg_age="avg_age",
    bucket="event_date",
    bucket_label=day_label,
    age_limits=True,
    messages=DAILY_MESSAGE_SCHEMA,
)
HOURLY = GoldShape(
    name="gold_hourly_stats",
    size="1 hour",
    rows="users_this_hour",
    users="unique_users_this_hour",
    avg_age="avg_age_this_hour",
    bucket="hour_bucket",
    bucket_label=hour_label,
    age_limits=False,
    messages=HOURLY_MESSAGE_SCHEMA,
)


def user_rollup(users: DataFrame, size: str) -> DataFrame:
    """One row per (window, country, user): the level that makes a distinct count
    of users a plain count. The user is part of the shuffle key, so a country or
    window with most of the rows is spread over all tasks, and a user with most
    of the rows is combined on the map side."""
    return users.groupBy(F.window("kafka_timestamp", size), "country_code", "user_key").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("age_validated").alias("age_sum"),
        F.count("age_validated").alias("age_n"),
        F.min("age_validated").alias("age_min"),
        F.max("age_validated").alias("age_max"),
        F.max("processed_at").alias("updated"),
    )


def coarsen_rollup(rollup: DataFrame, size: str) -> DataFrame:
    """A rollup over larger windows from one over smaller windows, so hourly and
    daily tables can share one pass over the rows."""
    coarse = rollup.select(F.window(F.col("window.start"), size).alias("coarse"), *(c for c in rollup.columns if c != "window"))
    return combine_rollup(coarse, "coarse").withColumnRenamed("coarse", "window")


def combine_rollup(rollup: DataFrame, *window: str) -> DataFrame:
    """One row per (window, country, user) from any number of them."""
    return rollup.groupBy(*window, "country_code", "user_key").agg(
        F.sum("n").alias("n"),
        F.sum("age_sum").alias("age_sum"),
        F.sum("age_n").alias("age_n"),
        F.min("age_min").alias("age_min"),
        F.max("age_max").alias("age_max"),
        F.max("updated").alias("updated"),
    )


def stats_from_rollup(rollup: DataFrame, shape: GoldShape) -> DataFrame:
    """Statistics per (window, country). Null user keys add rows but no user."""
    stats = rollup.groupBy("window", "country_code").agg(
        F.sum("n").alias(shape.rows),
        F.count("user_key").alias(shape.users),
        F.round(F.try_divide(F.sum("age_sum"), F.sum("age_n")), 1).alias(shape.avg_age),
        F.min("age_min").alias("min_age"),
        F.max("age_max").alias("max_age"),
        F.max("updated").alias("last_updated"),
    )
    return shaped(stats, shape)


def shaped(stats: DataFrame, shape: GoldShape) -> DataFrame:
    """Final columns: the window start becomes a day or hour label in UTC."""
    limits = ("min_age", "max_age") if shape.age_limits else ()
    return stats.select(
        "country_code",
        shape.rows,
        shape.users,
        shape.avg_age,
        *limits,
        shape.bucket_label(stats, "window.start").alias(shape.bucket),
        "last_updated",
    )


def country_stats(users: DataFrame, shape: GoldShape) -> DataFrame:
    """Exact statistics of valid users with envelope columns (batch)."""
    return stats_from_rollup(user_rollup(users, shape.size), shape)


def load_gold(envelopes: DataFrame, shape: GoldShape) -> DataFrame:
    """Gold messages to warehouse rows: decode, convert the time, stamp."""
    return (
        decode_values(envelopes, shape.messages)
        .withColumns(
            {
                "last_updated_timestamp": F.timestamp_millis("LAST_UPDATED"),
                "ingested_at": F.current_timestamp(),
                "source": F.lit(GOLD_SOURCE),
            }
        )
        .drop("LAST_UPDATED")
    )


def current_gold(changelog: DataFrame, shape: GoldShape) -> DataFrame:
    """Newest version of each (country, bucket) in an append-only update log.

    Versions order by (batch_id, last_updated): a late record changes counts
    without raising ``last_updated``.
    """
    return current_rows(changelog, shape.keys, ["last_updated"])
