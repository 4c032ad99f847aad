"""Silver under the ``strict`` policy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.functions import checks, text
from tierflow.functions.keys import record_key
from tierflow.functions.times import epoch_millis, parse_timestamp

#: User fields the strict policy reads; hand them to ``decode_messages``.
INPUT_FIELDS = (
    "user_id", "uuid", "name", "email", "age", "country", "fetched_at", "source", "api_version",
)
#: Message columns kept for windows and for ordering.
ENVELOPE = ("kafka_timestamp", "partition", "offset")


def clean_users(raw: DataFrame, keep_envelope: bool = False) -> DataFrame:
    """Key, cleaned fields and VALID/INVALID status, one row per input row."""
    return raw.select(
        record_key().alias("user_key"),
        "uuid",
        text.clean_name(F.col("name")).alias("name"),
        text.clean_email(F.col("email")).alias("email_normalized"),
        checks.age_or_null(F.col("age")).alias("age_validated"),
        text.canonical_country(F.col("country")).alias("country_code"),
        parse_timestamp(F.col("fetched_at")).alias("fetched_timestamp"),
        checks.strict_status().alias("data_quality_status"),
        "source",
        "api_version",
        epoch_millis(raw, "kafka_timestamp").alias("processed_at"),
        *(ENVELOPE if keep_envelope else ()),
    )


def valid_users(cleaned: DataFrame) -> DataFrame:
    return cleaned.filter(F.col("data_quality_status") == checks.VALID)


def invalid_users(cleaned: DataFrame) -> DataFrame:
    """Rejected rows with the reason and the rejection (message) time."""
    return cleaned.filter(F.col("data_quality_status") == checks.INVALID).select(
        "*",
        F.lit(checks.ERROR_TYPE).alias("error_type"),
        F.col("processed_at").alias("rejected_at"),
    )
