"""Keyed message sink."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tierflow.operators.messages import encode_messages
from tierflow.settings import Settings
from tierflow.sinks.tables import Target, append_table, write_batch

logger = logging.getLogger(__name__)

# Delivery settings of the producer.
DELIVERY = {"kafka.acks": "all", "kafka.retries": "3"}


def send_messages(
    messages: DataFrame, settings: Settings, topic: str, batch_id: int | None = None
) -> None:
    """Send (key, value) rows to a topic. A folder of files stands for a topic in the
    other formats; there a batch that is sent again adds nothing."""
    if settings.message_format == "kafka":
        options = {
            "kafka.bootstrap.servers": settings.bootstrap,
            "topic": topic,
            **DELIVERY,
            **settings.message_options,
        }
        messages.write.format("kafka").options(**options).save()
        return
    binary = messages.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
    )
    place = Target(topic, settings.message_format, logged=False)
    if batch_id is None:
        append_table(binary, place)
    else:
        write_batch(binary, place, batch_id)


def send_records(records: DataFrame, settings: Settings, topic: str | None = None) -> int:
    """Send each record as one keyed JSON message; returns the number sent.

    The count is observed during the write, so it costs no second pass.
    """
    topic = topic or settings.topic
    sent = Observation()
    messages = encode_messages(records).observe(sent, F.count(F.lit(1)).alias("sent"))
    send_messages(messages, settings, topic)
    count = int(sent.get["sent"])
    logger.info("sent %s messages to %s", count, topic)
    return count
