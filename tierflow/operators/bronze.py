"""Bronze: decoded messages with lineage columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.times import parsed_date


def to_bronze(decoded: DataFrame, batch_id: int | str, ingested_at: Column | None = None) -> DataFrame:
    """Add ingest time, event date, batch id (as text) and source file."""
    return decoded.withColumns(
        {
            "ingested_at": F.current_timestamp() if ingested_at is None else ingested_at,
            "event_date": parsed_date(F.col("fetched_at")),
            "batch_id": F.lit(str(batch_id)),
            "source_file": F.input_file_name(),
        }
    )


#: Folder level of stored bronze rows: the UTC day they were ingested on.
INGEST_DATE = "ingest_date"


def recent(
    bronze: DataFrame, as_of: Column | None = None, span: str = "1 HOURS", until: bool = False
) -> DataFrame:
    """Rows ingested no earlier than ``span`` before ``as_of`` (default: now) and, with
    ``until``, before ``as_of``: adjoining spans then share no row.

    The bounds fold to literals, so they reach the scan as pushed filters. A stored
    table is pruned by its days of ingestion as well.
    """
    now = F.current_timestamp() if as_of is None else as_of
    start = now - F.expr(f"INTERVAL {span}")
    chosen = bronze.filter(F.col("ingested_at") >= start)
    if until:
        chosen = chosen.filter(F.col("ingested_at") < now)
    if INGEST_DATE in bronze.columns:
        day = F.col(INGEST_DATE)
        chosen = chosen.filter(day >= start.cast("date"))
        if until:
            chosen = chosen.filter(day <= now.cast("date"))
    return chosen
