"""Micro-batch callbacks. A failed write fails its batch, which is then retried."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tierflow.operators.bronze import to_bronze
from tierflow.operators.messages import split_malformed
from tierflow.operators.quality import quality_counts, split_by_quality
from tierflow.sinks.tables import Target, commit_empty, ensure_table, is_published, write_batch

logger = logging.getLogger(__name__)

BatchWriter = Callable[[DataFrame, int], None]


def writes(write: BatchWriter, *tables: Target) -> BatchWriter:
    """Name the tables that hold a batch when it is done."""
    write.tables = tables
    return write


#: Layout column of tables whose rows already carry another layer's batch id.
LOAD_ID = "load_id"


def _layout(rows: DataFrame) -> StructType:
    return StructType([*rows.schema.fields, StructField(LOAD_ID, LongType())])


def bronze_writer(target: Target) -> BatchWriter:
    """One ingest time per batch, so that a batch lies in one day's folder.

    A connector is asked for emptiness first: an observation counts the rows of the
    first action on its frame, which must be the write.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        if is_published(df.sparkSession, target, batch_id):
            logger.info("bronze batch %s is written already", batch_id)
            return
        if not target.is_files and df.isEmpty():
            logger.info("bronze batch %s: 0 records", batch_id)
            return
        now, seen = dt.datetime.now(dt.timezone.utc), Observation()
        bronze = to_bronze(df, batch_id, F.lit(now))
        counted = bronze.observe(seen, F.count(F.lit(1)).alias("records"))
        if write_batch(counted, target, batch_id, stamp=now.date().isoformat(), filled=True):
            logger.info("bronze batch %s: %s records", batch_id, seen.get["records"])

    return writes(write, target)


def split_writer(write: BatchWriter, malformed: Target) -> BatchWriter:
    """Set messages aside that are no JSON object; the rest goes to ``write``. Both read
    the micro-batch from a disk-backed cache, so it is parsed once."""

    def split(df: DataFrame, batch_id: int) -> None:
        cached = df.persist()
        try:
            decoded, broken = split_malformed(cached)
            write(decoded, batch_id)
            write_batch(broken, malformed, batch_id)
        finally:
            cached.unpersist()

    return writes(split, *getattr(write, "tables", ()), malformed)


def silver_writer(complete: Target, quarantine: Target) -> BatchWriter:
    """Complete rows to one table, the rest to another.

    The counts and both writes read the micro-batch from a disk-backed cache, so the
    source is read and scored once; lost blocks are computed again from the source.
    The batch id of bronze stays a plain column: one bronze batch may arrive in
    several micro-batches here, so it cannot name the part to replace.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        cached = df.persist()
        try:
            counts = cached.agg(*quality_counts()).first().asDict()
            sizes = counts["complete"], counts["quarantined"]
            for rows, target, n in zip(split_by_quality(cached), (complete, quarantine), sizes):
                if n:
                    write_batch(rows, target, batch_id, key=LOAD_ID, filled=True)
                else:
                    # Readers find a table, though an empty one.
                    ensure_table(df.sparkSession, replace(target, partition_by=(LOAD_ID,)), _layout(rows))
                    commit_empty(df.sparkSession, target, batch_id, key=LOAD_ID)
            logger.info("silver batch %s: %s", batch_id, counts)
        finally:
            cached.unpersist()

    return writes(write, complete, quarantine)


def table_writer(target: Target, key: str = "batch_id", sample: int = 0) -> BatchWriter:
    """Rows as they come: stateless streams, and update logs of aggregates.
    ``sample`` prints that many rows of each batch."""

    def write(df: DataFrame, batch_id: int) -> None:
        if sample:
            df.limit(sample).show(truncate=False)
        write_batch(df, target, batch_id, key=key)

    return writes(write, target)
