"""Silver under the ``scored`` policy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions import checks
from tierflow.functions.keys import record_hash

_FLAGS = ("is_valid_email", "is_valid_age", "is_valid_country")


def flag_quality(df: DataFrame) -> DataFrame:
    """The three checks as boolean columns."""
    made = (checks.email_flag(), checks.age_flag(), checks.country_flag())
    return df.withColumns(dict(zip(_FLAGS, made)))


def score_quality(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Flags, score 0 to 3, completeness, processing time and record hash."""
    total = checks.score(*(F.col(f) for f in _FLAGS))
    return flag_quality(df).withColumns(
        {
            "data_quality_score": total,
            "is_complete": total >= checks.MIN_SCORE,
            "processed_at": F.current_timestamp() if processed_at is None else processed_at,
            "record_hash": record_hash(),
        }
    )


def split_by_quality(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The complete rows and the rows for quarantine; every row is in one of them."""
    return scored.filter("is_complete"), scored.filter(~F.col("is_complete"))


def quality_counts() -> list[Column]:
    """Aggregates for one pass over scored rows: use with ``agg`` or ``observe``."""
    return [
        F.count(F.lit(1)).alias("records"),
        F.count_if("is_complete").alias("complete"),
        F.count_if(~F.col("is_complete")).alias("quarantined"),
        *(F.count_if(flag).alias(flag.replace("is_", "")) for flag in _FLAGS),
    ]


def quality_summary(scored: DataFrame) -> DataFrame:
    return scored.agg(*quality_counts())
