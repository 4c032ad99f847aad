"""Time expressions that do not depend on the session time zone.

Message times arrive as TIMESTAMP from a stream and as TIMESTAMP_NTZ (taken as
UTC) from stored tables; the helpers below read the column's type and pick the
matching built-in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Formats of day and stamp columns.
DAY_FORMAT = "yyyy-MM-dd"
STAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

_EPOCH = "1970-01-01 00:00:00"


def _epoch() -> Column:
    return F.lit(_EPOCH).cast("timestamp_ntz")


def is_ntz(df: DataFrame, name: str) -> bool:
    return df.select(name).schema[0].dataType.typeName() == "timestamp_ntz"


def epoch_millis(df: DataFrame, name: str) -> Column:
    """Milliseconds since the epoch of a time column."""
    if is_ntz(df, name):
        return F.timestamp_diff("MILLISECOND", _epoch(), F.col(name))
    return F.unix_millis(F.col(name))


def utc_ntz(ts: Column) -> Column:
    """The UTC wall clock of an instant, whatever the session zone is."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), _epoch())


def ntz_as_utc(ts: Column) -> Column:
    """The instant whose UTC wall clock is ``ts``; watermarks need an instant."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), ts))


def millis_to_ntz(millis: Column) -> Column:
    return F.timestamp_add("MILLISECOND", millis, _epoch())


def _utc_text(df: DataFrame, name: str) -> Column:
    ts = F.col(name)
    return (ts if is_ntz(df, name) else utc_ntz(ts)).cast("string")


def day_label(df: DataFrame, name: str) -> Column:
    """``yyyy-MM-dd`` of a time column in UTC."""
    return F.substring(_utc_text(df, name), 1, 10)


def hour_label(df: DataFrame, name: str) -> Column:
    """``yyyy-MM-dd HH:00`` of a time column in UTC."""
    return F.concat(F.substring(_utc_text(df, name), 1, 13), F.lit(":00"))


def parse_timestamp(text: Column) -> Column:
    """Text to TIMESTAMP; text that is no time gives null under any ANSI setting."""
    return text.try_cast("timestamp")


def parsed_date(text: Column) -> Column:
    return F.date_format(parse_timestamp(text), DAY_FORMAT)


def stamp_now() -> Column:
    return F.date_format(F.current_timestamp(), STAMP_FORMAT)
