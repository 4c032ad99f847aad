"""Records that arrive more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.functions.keys import record_hash

RECORD_HASH = "record_hash"


def unique_records(rows: DataFrame, within: str) -> DataFrame:
    """One row per record hash, with the hash.

    Of a stream the first to arrive stays. A hash is remembered until the watermark, the
    newest message time less ``within``, has passed the message it came with by as much:
    repeats that come closer to each other than ``within`` are dropped, what lies behind
    the watermark is dropped as late, and state stays bounded by the hashes of that span.
    In a batch table the row with the smallest (message time, partition, offset) stays,
    whatever the distance.
    """
    hashed = rows.withColumn(RECORD_HASH, record_hash())
    if rows.isStreaming:
        return hashed.withWatermark("kafka_timestamp", within).dropDuplicatesWithinWatermark([RECORD_HASH])
    order = F.struct("kafka_timestamp", "partition", "offset")
    first = hashed.groupBy(RECORD_HASH).agg(F.min_by(F.struct(*hashed.columns), order).alias("first"))
    return first.select("first.*")
