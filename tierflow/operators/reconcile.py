"""Comparing what was expected with what was delivered. Nothing here fails a job."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

logger = logging.getLogger(__name__)

MISMATCH = "Delivery mismatch: %s records expected, %s sent"


def _tagged(expected: DataFrame, sent: DataFrame, *keys: str) -> DataFrame:
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    left = expected.select(*keys, one.alias("expected"), zero.alias("sent"))
    right = sent.select(*keys, zero.alias("expected"), one.alias("sent"))
    return left.unionByName(right)


def reconcile_counts(expected: DataFrame, sent: DataFrame) -> DataFrame:
    """One row: expected, sent, matched. Two empty sides match."""
    counted = _tagged(expected, sent).agg(
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("expected", "sent"))
    )
    return counted.withColumn("matched", F.col("expected") == F.col("sent"))


def missing_keys(expected: DataFrame, sent: DataFrame, *keys: str) -> DataFrame:
    """Keys whose number of rows differs, with both counts.

    A tagged union and one aggregation do the work of a full outer join: each
    side is counted on the map side before the shuffle, so a repeated key costs
    one row per task and no pairs are formed. Null keys are compared too.
    """
    counted = _tagged(expected, sent, *keys).groupBy(*keys).agg(
        F.sum("expected").alias("expected"), F.sum("sent").alias("sent")
    )
    return counted.filter(F.col("expected") != F.col("sent"))


def report_delivery(expected: int | None, sent: int | None) -> bool:
    """Log a warning on mismatch and return whether the counts agree.

    An absent count (a step that returned nothing) is a mismatch, not an error.
    """
    matched = expected is not None and expected == sent
    if matched:
        logger.info("delivery validated: %s records", sent)
    else:
        logger.warning(MISMATCH, expected or 0, sent)
    return matched
