"""Record files: response bodies kept as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierflow.operators.records import normalise_records
from tierflow.schemas import API_SCHEMA


def read_records(spark: SparkSession, *paths: str) -> DataFrame:
    """Raw records from files that hold a list of objects or a single object.

    Each file is one response body and becomes one task's input, so bodies stay
    small while their number may grow.
    """
    bodies = spark.read.schema(API_SCHEMA).option("multiLine", True).json(list(paths))
    return normalise_records(bodies)
