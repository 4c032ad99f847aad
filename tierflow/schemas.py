"""Declared schemas of every layer. All fields are nullable."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names.split()]


# Field names, types and order of the records on the wire.
USER_SCHEMA = T.StructType(
    _strings("user_id username uuid email name first_name last_name gender")
    + [T.StructField("age", T.IntegerType())]
    + _strings("country city phone job company ipv4 ipv6 fetched_at source api_version")
)

# Keys of one record in an API response body.
API_SCHEMA = T.StructType(
    _strings("id username uuid name first_name last_name gender")
    + [T.StructField("age", T.IntegerType())]
    + _strings(
        "dob email phone cell address street_address city state postal_code country "
        "latitude longitude job company company_email ipv4 ipv6 mac_address user_agent "
        "timezone locale picture avatar"
    )
)

# The raw record: the response keys with ``id`` renamed, plus three stamps.
RAW_SCHEMA = T.StructType(
    _strings("user_id")
    + API_SCHEMA.fields[1:]
    + _strings("fetched_at source api_version")
)

# Rows of a message source, as the Kafka connector delivers them.
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

DECODED_SCHEMA = T.StructType(
    USER_SCHEMA.fields
    + [
        T.StructField("kafka_timestamp", T.TimestampType()),
        T.StructField("offset", T.LongType()),
        T.StructField("partition", T.IntegerType()),
    ]
)

BRONZE_SCHEMA = T.StructType(
    DECODED_SCHEMA.fields
    + [T.StructField("ingested_at", T.TimestampType())]
    + _strings("event_date batch_id source_file")
)

SILVER_SCHEMA = T.StructType(
    BRONZE_SCHEMA.fields
    + [
        T.StructField("is_valid_email", T.BooleanType()),
        T.StructField("is_valid_age", T.BooleanType()),
        T.StructField("is_valid_country", T.BooleanType()),
        T.StructField("data_quality_score", T.IntegerType()),
        T.StructField("is_complete", T.BooleanType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("record_hash", T.StringType()),
    ]
)

_ENVELOPE_FIELDS = [
    T.StructField("kafka_timestamp", T.TimestampType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
]

# The stored cleaned stream: cleaned fields, then what orders and windows need.
CLEANED_SCHEMA = T.StructType(
    _strings("user_key uuid name email_normalized")
    + [T.StructField("age_validated", T.IntegerType())]
    + _strings("country_code")
    + [T.StructField("fetched_timestamp", T.TimestampType())]
    + _strings("data_quality_status source api_version")
    + [T.StructField("processed_at", T.LongType())]
    + _ENVELOPE_FIELDS
)

# Upper-case field names of the gold messages.
DAILY_MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("COUNTRY_CODE", T.StringType()),
        T.StructField("TOTAL_USERS", T.LongType()),
        T.StructField("UNIQUE_USERS", T.LongType()),
        T.StructField("AVG_AGE", T.DoubleType()),
        T.StructField("MIN_AGE", T.IntegerType()),
        T.StructField("MAX_AGE", T.IntegerType()),
        T.StructField("EVENT_DATE", T.StringType()),
        T.StructField("LAST_UPDATED", T.LongType()),
    ]
)

HOURLY_MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("COUNTRY_CODE", T.StringType()),
        T.StructField("USERS_THIS_HOUR", T.LongType()),
        T.StructField("UNIQUE_USERS_THIS_HOUR", T.LongType()),
        T.StructField("AVG_AGE_THIS_HOUR", T.DoubleType()),
        T.StructField("HOUR_BUCKET", T.StringType()),
        T.StructField("LAST_UPDATED", T.LongType()),
    ]
)
