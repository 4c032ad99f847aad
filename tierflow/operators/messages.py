"""Records to keyed JSON messages and back."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierflow.functions.keys import message_key
from tierflow.schemas import USER_SCHEMA

_KEEP_NULLS = {"ignoreNullFields": "false"}


def encode_messages(records: DataFrame, *metadata: Column | str) -> DataFrame:
    """One ``(key, value)`` text pair per record, nulls kept in the JSON.

    ``metadata`` columns go beside the message and stay out of key and value.
    """
    named = {m for m in metadata if isinstance(m, str)}
    fields = [c for c in records.columns if c not in named]
    return records.select(
        message_key(fields).alias("key"),
        F.to_json(F.struct(*fields), _KEEP_NULLS).alias("value"),
        *metadata,
    )


def encode_gold(stats: DataFrame) -> DataFrame:
    """Gold rows as messages with upper-case field names, keyed by country."""
    fields = [F.col(c).alias(c.upper()) for c in stats.columns]
    return stats.select(
        F.col("country_code").alias("key"),
        F.to_json(F.struct(*fields), _KEEP_NULLS).alias("value"),
    )


#: The text of a message that is no JSON object, beside the decoded columns.
MALFORMED = "malformed_value"
# Why a message was set aside.
NO_OBJECT, NO_TEXT = "MALFORMED_JSON", "EMPTY_MESSAGE"


def decode_values(
    envelopes: DataFrame, schema: StructType, *metadata: Column | str, malformed: bool = False
) -> DataFrame:
    """Parse ``value`` against a declared schema and flatten it.

    Keys outside the schema are dropped; text that is no JSON object gives a row
    of nulls, so no message is lost. ``inline`` keeps the parse in one operator:
    a plain projection lets later filters and columns each repeat ``from_json``.

    With ``malformed`` the same parse also gives the text of messages of which it could
    read no field (empty for a message without text), else null, for
    :func:`split_malformed`.
    """
    value = F.col("value").cast("string")
    if not malformed:
        return envelopes.select(F.inline(F.array(F.from_json(value, schema))), *metadata)
    wide = StructType([*schema.fields, StructField(MALFORMED, StringType())])
    body = F.from_json(value, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED})
    blank = F.coalesce(F.trim(value) == "", F.lit(True))
    parsed = envelopes.select(F.inline(F.array(body)), *metadata, blank.alias("__blank"))
    unread = reduce(lambda a, b: a & b, (F.col(f"`{name}`").isNull() for name in schema.fieldNames()))
    text = F.when(F.col("__blank"), F.lit("")).when(unread, F.col(MALFORMED))
    return parsed.withColumn(MALFORMED, text).drop("__blank")


def split_malformed(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Decoded rows, and those of messages that were no JSON object: their text, why
    they were set aside, and their time, offset and partition."""
    value = F.col(MALFORMED)
    broken = decoded.filter(value.isNotNull()).select(
        value.alias("value"),
        F.when(value == "", NO_TEXT).otherwise(NO_OBJECT).alias("error_type"),
        "kafka_timestamp",
        "offset",
        "partition",
    )
    return decoded.filter(value.isNull()).drop(MALFORMED), broken


def decode_messages(
    envelopes: DataFrame, fields: Collection[str] | None = None, malformed: bool = False
) -> DataFrame:
    """User messages to typed columns plus message time, offset and partition.

    ``fields`` names the user fields a consumer needs; the parser skips the rest.
    ``malformed`` adds the text of messages that are no JSON object.
    """
    wanted = [f for f in USER_SCHEMA.fields if fields is None or f.name in fields]
    time = F.col("timestamp").alias("kafka_timestamp")
    return decode_values(envelopes, StructType(wanted), time, "offset", "partition", malformed=malformed)
