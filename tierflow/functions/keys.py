"""Keys and hashes of a record."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def record_key() -> Column:
    """First non-null of user_id and uuid. An empty user_id counts as present."""
    return F.coalesce("user_id", "uuid")


def message_key(columns: Iterable[str]) -> Column:
    """First non-blank of user_id and uuid, else a hash of the whole record.

    Unlike :func:`record_key` this skips empty strings. The hash covers the
    record as JSON with sorted keys, so it is the same on every run and host.
    """
    present = set(columns)
    named = [F.nullif(F.col(c), F.lit("")) for c in ("user_id", "uuid") if c in present]
    body = F.to_json(F.struct(*sorted(present)), {"ignoreNullFields": "false"})
    return F.coalesce(*named, F.sha2(body, 256))


def record_hash() -> Column:
    """SHA-256 over three identifying fields; nulls keep their slot."""
    parts = [F.coalesce(F.col(c), F.lit("")) for c in ("user_id", "uuid", "fetched_at")]
    return F.sha2(F.concat_ws("|", *parts), 256)
