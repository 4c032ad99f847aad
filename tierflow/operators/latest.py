"""Newest values per user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.operators.log import current_rows
from tierflow.operators.silver import valid_users

# Output name -> cleaned column.
_COLUMNS = {
    "uuid": "uuid",
    "name": "name",
    "email": "email_normalized",
    "age": "age_validated",
    "country": "country_code",
    "last_seen": "fetched_timestamp",
    "last_processed": "processed_at",
}
# The strict policy lets no valid row through with one of these null, so their
# newest non-null value is the one of the newest row and one state serves all.
_NEVER_NULL = ("name", "email", "age", "country", "last_processed")


def latest_users(cleaned: DataFrame, ignore_nulls: bool = True) -> DataFrame:
    """One row per user key of the valid rows, batch or streaming (update mode).

    ``cleaned`` carries the envelope columns. "Newest" is the greatest
    (message time, partition, offset): offsets alone compare only inside one
    partition. With ``ignore_nulls`` each column takes its newest non-null value,
    else all columns come from the newest row. ``max_by`` combines on the map
    side, so a key that holds a large share of the rows reaches its reducer as
    one partial row per map task. Rows without a key belong to no user.
    """
    order = F.struct("kafka_timestamp", "partition", "offset")
    whole = _NEVER_NULL if ignore_nulls else tuple(_COLUMNS)
    apart = [name for name in _COLUMNS if name not in whole]

    def newest(name: str) -> Column:
        value = F.col(_COLUMNS[name])
        return F.max_by(value, F.when(value.isNotNull(), order)).alias(name)

    row = F.struct(*(F.col(_COLUMNS[name]).alias(name) for name in whole))
    found = (
        valid_users(cleaned)
        .filter(F.col("user_key").isNotNull())
        .groupBy("user_key")
        .agg(
            F.max_by(row, order).alias("row"),
            *(newest(name) for name in apart),
            F.count(F.lit(1)).alias("record_count"),
        )
    )
    picked = [F.col(f"row.{name}" if name in whole else name).alias(name) for name in _COLUMNS]
    return found.select("user_key", *picked, "record_count")


_ORDER = ("kafka_timestamp", "partition", "offset")
_APART = tuple(name for name in _COLUMNS if name not in _NEVER_NULL)


def latest_parts(cleaned: DataFrame) -> DataFrame:
    """What some rows say of each user's newest values, to be put together with what
    others say: the values with the order of the rows that they come from."""
    order = F.struct(*_ORDER)
    row = F.struct(*(F.col(_COLUMNS[name]).alias(name) for name in _NEVER_NULL))

    def apart(name: str) -> Column:
        value = F.col(_COLUMNS[name])
        pair = F.struct(order.alias("order"), value.alias("value"))
        return F.max_by(pair, F.when(value.isNotNull(), order)).alias(name)

    return (
        valid_users(cleaned)
        .filter(F.col("user_key").isNotNull())
        .groupBy("user_key")
        .agg(
            F.max_by(F.struct(order.alias("order"), row.alias("value")), order).alias("row"),
            *(apart(name) for name in _APART),
            F.count(F.lit(1)).alias("record_count"),
        )
    )


def combine_parts(parts: DataFrame, *more: str) -> DataFrame:
    """One row per user from any number of :func:`latest_parts`; ``more`` columns depend
    on the user alone."""
    newest = [F.max_by(name, F.col(f"{name}.order")).alias(name) for name in ("row", *_APART)]
    return parts.groupBy("user_key", *more).agg(*newest, F.sum("record_count").alias("record_count"))


def latest_from_parts(parts: DataFrame) -> DataFrame:
    """The columns of :func:`latest_users` from combined parts."""
    values = [F.col(f"row.value.{name}" if name in _NEVER_NULL else f"{name}.value").alias(name) for name in _COLUMNS]
    return parts.select("user_key", *values, "record_count")


def current_latest_users(log: DataFrame) -> DataFrame:
    """One row per user from the update log that the streaming query leaves."""
    return current_rows(log, ["user_key"])
