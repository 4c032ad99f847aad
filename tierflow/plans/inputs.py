"""User records derived from the ``events`` table.

Each event becomes one user record with the defects the layers must handle. The
expressions are valid in Spark and in ANSI engines alike, so the same text
derives the input on both sides of a comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.times import ntz_as_utc
from tierflow.operators.messages import encode_messages

_UID = "CAST(user_id AS STRING)"

USER_EXPRESSIONS = {
    "user_id": f"CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 23 = 0 THEN '' ELSE {_UID} END",
    "username": f"concat('user', {_UID})",
    "uuid": f"CASE WHEN event_id % 29 <> 0 THEN concat('u-', {_UID}) END",
    "email": (
        "CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'broken@' "
        f"WHEN 2 THEN concat(' USER', {_UID}, '@Example.COM ') "
        f"ELSE concat('user', {_UID}, '@example.com') END"
    ),
    "name": f"CASE WHEN event_id % 13 = 0 THEN '   ' ELSE concat(' User ', {_UID}, ' ') END",
    "first_name": f"concat('First', {_UID})",
    "last_name": f"concat('Last', {_UID})",
    "gender": "CASE user_id % 2 WHEN 0 THEN 'female' ELSE 'male' END",
    "age": "CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(event_id % 131 - 5 AS INT) END",
    "country": (
        "CASE event_id % 10 WHEN 0 THEN 'Thailand' WHEN 1 THEN 'th' WHEN 2 THEN 'USA' "
        "WHEN 3 THEN 'united states' WHEN 4 THEN 'UK' WHEN 5 THEN 'GB' WHEN 6 THEN 'de' "
        "WHEN 7 THEN '' WHEN 8 THEN NULL ELSE 'US' END"
    ),
    "city": "CASE user_id % 3 WHEN 0 THEN 'Bangkok' WHEN 1 THEN 'Łódź' ELSE NULL END",
    "phone": f"concat('+66-', {_UID})",
    "job": "concat('job \"', event_type, '\"')",
    "company": "props",
    "ipv4": "concat('10.0.0.', CAST(user_id % 256 AS STRING))",
    "ipv6": "concat('fd00::', CAST(user_id % 9999 AS STRING))",
    "fetched_at": "CASE WHEN event_id % 19 = 0 THEN 'not-a-date' ELSE replace(CAST(ts AS STRING), ' ', 'T') END",
    "source": "'api-ninjas-randomuser'",
    "api_version": "'v2'",
}
ENVELOPE_EXPRESSIONS = {
    "kafka_timestamp": "ts",
    "offset": "event_id",
    "partition": "CAST(event_id % 3 AS INT)",
}

#: Keys of a response body filled from the same rows.
API_EXPRESSIONS = {
    "id": USER_EXPRESSIONS["user_id"],
    **{k: v for k, v in USER_EXPRESSIONS.items() if k not in ("user_id", "fetched_at", "source", "api_version")},
    "state": "event_type",
    "latitude": "CAST(user_id % 90 AS STRING)",
}


#: Some messages as a faulty sender would leave them: cut off, no JSON, without text.
FAULTY_VALUE = (
    "CASE WHEN {offset} % 37 = 0 THEN left({value}, length({value}) - 3) WHEN {offset} % 41 = 0 THEN 'not json' "
    "WHEN {offset} % 43 = 0 THEN '' WHEN {offset} % 47 = 0 THEN NULL ELSE {value} END"
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as a file stream. A pattern fits a single file and a folder of
    part files alike; a plain path must be a folder."""
    schema = events(spark, sf_dir).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/[e]vents.parquet")


def _select(df: DataFrame, expressions: dict[str, str]) -> DataFrame:
    return df.selectExpr(*(f"{sql} AS `{name}`" for name, sql in expressions.items()))


def raw_users(events_df: DataFrame) -> DataFrame:
    """The 19 user fields with message time, offset and partition."""
    return _select(events_df, {**USER_EXPRESSIONS, **ENVELOPE_EXPRESSIONS})


def api_records(events_df: DataFrame, **more: str) -> DataFrame:
    return _select(events_df, {**API_EXPRESSIONS, **more})


def as_instants(raw: DataFrame) -> DataFrame:
    """Message time as an instant, the type a message source delivers."""
    return raw.withColumn("kafka_timestamp", ntz_as_utc(F.col("kafka_timestamp")))


def envelopes(raw: DataFrame) -> DataFrame:
    """The records as rows of a message source; ``timestamp`` keeps its type."""
    return encode_messages(raw, *ENVELOPE_EXPRESSIONS).select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit("Raw_Data").alias("topic"),
        "partition",
        "offset",
        F.col("kafka_timestamp").alias("timestamp"),
    )


def faulty(messages: DataFrame) -> DataFrame:
    """Envelopes of which some hold no record."""
    text = FAULTY_VALUE.format(offset="offset", value="CAST(value AS STRING)")
    return messages.withColumn("value", F.expr(text).cast("binary"))
