"""Newest values per user of a stream without streaming state.

What each micro-batch says of its users is stored, dealt into buckets by user. The new
values of the users that it touched are put together from the stored rows of their
buckets, and rows of many batches are combined in levels, as for gold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tierflow.operators.latest import combine_parts, latest_from_parts, latest_parts
from tierflow.schemas import CLEANED_SCHEMA
from tierflow.sinks.commits import Commit, Entry
from tierflow.sinks.merging import FAN, merge_batches
from tierflow.sinks.tables import Target, is_published, opened, write_batch
from tierflow.sources.tables import read_entries
from tierflow.streaming.writers import BatchWriter, writes

BUCKET = "bucket"


def store_schema(spark: SparkSession) -> StructType:
    parts = latest_parts(spark.createDataFrame([], CLEANED_SCHEMA)).schema
    return StructType([*parts.fields, StructField(BUCKET, IntegerType())])


def latest_writer(store: Target, output: Target, buckets: int = 64, fan: int = FAN) -> BatchWriter:
    """Log the new values of all users that a batch of cleaned rows touches.

    ``store`` is partitioned by ``bucket``. The number of buckets is part of the stored
    rows: it stays as it was when the table was made.
    """

    def write(cleaned: DataFrame, batch_id: int) -> None:
        spark = cleaned.sparkSession
        schema = store_schema(spark)
        log = opened(spark, store)
        batch = log.claim(batch_id)
        parts = latest_parts(cleaned)
        parts = parts.withColumn(BUCKET, F.pmod(F.xxhash64("user_key"), F.lit(buckets)).cast("int"))
        write_batch(parts, store, batch_id)
        if not is_published(spark, output, batch_id):

            def read(entries: list[Entry], only=None) -> DataFrame:
                return read_entries(spark, store.name, entries, store.fmt, store.options, schema, only)

            entries = [entry for entry in log.entries() if entry.batch <= batch]
            own = entries[-1:]
            # A batch that is tried again after its rows were combined takes them from its input.
            mine = read(own) if own and isinstance(own[0], Commit) and own[0].batch == batch else parts
            touched = [row[BUCKET] for row in mine.select(BUCKET).distinct().collect()]
            past = read(entries, {BUCKET: [str(bucket) for bucket in touched]})
            changed = past.join(mine.select("user_key"), "user_key", "left_semi")
            write_batch(latest_from_parts(combine_parts(changed)), output, batch_id)
        merge_batches(spark, store, schema, combine=_combined, fan=fan)

    return writes(write, output)


def _combined(rows: DataFrame) -> DataFrame:
    return combine_parts(rows, BUCKET)
