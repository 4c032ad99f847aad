"""Response records to raw records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.times import stamp_now
from tierflow.schemas import RAW_SCHEMA

# Constants stamped on every raw record.
SOURCE = "api-ninjas-randomuser"
API_VERSION = "v2"


def normalise_records(records: DataFrame, fetched_at: Column | None = None) -> DataFrame:
    """Rename ``id``, fill absent keys with null and add the three stamps."""
    present = set(records.columns)
    made = {
        "user_id": F.col("id") if "id" in present else F.lit(None),
        "fetched_at": stamp_now() if fetched_at is None else fetched_at,
        "source": F.lit(SOURCE),
        "api_version": F.lit(API_VERSION),
    }
    return records.select(
        *(
            made.get(f.name, F.col(f.name) if f.name in present else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in RAW_SCHEMA.fields
        )
    )
