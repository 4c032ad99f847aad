"""Message sources."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tierflow.schemas import ENVELOPE_SCHEMA
from tierflow.settings import Settings


def kafka_options(settings: Settings, topic: str, starting: str) -> dict[str, str]:
    if not settings.bootstrap:
        raise ValueError("set bootstrap to the brokers of the message system")
    return {
        "kafka.bootstrap.servers": settings.bootstrap,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "false",
        **settings.message_options,
    }


def stream_messages(
    spark: SparkSession,
    settings: Settings,
    topic: str | None = None,
    starting: str = "latest",
) -> DataFrame:
    """Subscribe to one topic, from its end (``latest``) or from its start
    (``earliest``). A file format reads envelope rows from the folder ``topic``, about
    ``max_bytes`` of files at a time; for brokers set ``maxOffsetsPerTrigger`` among the
    message options."""
    topic = topic or settings.topic
    if settings.message_format == "kafka":
        reader = spark.readStream.format("kafka").options(**kafka_options(settings, topic, starting))
        return reader.load()
    options = dict(settings.message_options)
    if settings.max_bytes is not None:
        options.setdefault("maxBytesPerTrigger", settings.max_bytes)
    return stream_files(spark, topic, settings.message_format, options)


def stream_files(
    spark: SparkSession, path: str, fmt: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Envelope rows of all files below a folder, whatever folders batches add."""
    reader = spark.readStream.format(fmt).schema(ENVELOPE_SCHEMA)
    return reader.option("recursiveFileLookup", True).options(**(options or {})).load(path)
