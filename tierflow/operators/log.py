"""Update logs: append-only tables that hold every version of a row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.sinks.tables import Target, write_batch

VERSION = "batch_id"


def current_rows(
    log: DataFrame, keys: Sequence[str], order: Sequence[str] = (), version: str = VERSION
) -> DataFrame:
    """The newest version of each key, without the version column.

    Versions order by batch id, then by ``order``. One row per key and task reaches
    the shuffle, however many versions a key has.
    """
    values = [c for c in log.columns if c not in (*keys, version)]
    newest = F.struct(F.col(version).cast("long"), *order)
    found = log.groupBy(*keys).agg(F.max_by(F.struct(*values), newest).alias("row"))
    return found.select(*(c if c in keys else f"row.{c}" for c in log.columns if c != version))


def newest_versions(
    log: DataFrame, keys: Sequence[str], order: Sequence[str] = (), version: str = VERSION
) -> DataFrame:
    """The rows that :func:`current_rows` would pick, with their version."""
    newest = F.struct(F.col(version).cast("long"), *order)
    found = log.groupBy(*keys).agg(F.max_by(F.struct(*log.columns), newest).alias("row"))
    return found.select("row.*")


def compact_log(
    log: DataFrame, target: Target, keys: Sequence[str], through: int, order: Sequence[str] = ()
) -> None:
    """Write the newest versions up to batch ``through`` as that one batch of a new
    table. Readers of the new table see what readers of the log see; later batches of
    the log go on there. Compacting again changes nothing."""
    past = log.filter(F.col(VERSION).cast("long") <= through)
    write_batch(current_rows(past, keys, order), target, through)
