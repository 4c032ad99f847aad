"""The same results in ANSI SQL over the same tables, for another engine to run."""

from __future__ import annotations

from tierflow.functions.checks import AGE_HIGH, AGE_LOW, EMAIL_LIKE, EMAIL_REGEX, INVALID, VALID
from tierflow.functions.text import COUNTRY_SPELLINGS
from tierflow.plans.inputs import (
    API_EXPRESSIONS,
    ENVELOPE_EXPRESSIONS,
    FAULTY_VALUE,
    USER_EXPRESSIONS,
)


def _list(expressions: dict[str, str]) -> str:
    return ",\n    ".join(f'{sql} AS "{name}"' for name, sql in expressions.items())


_RAW = f"""raw_users AS (
  SELECT
    {_list({**USER_EXPRESSIONS, **ENVELOPE_EXPRESSIONS})}
  FROM events
)"""

_USER_COLUMNS = ", ".join(USER_EXPRESSIONS)
_MILLIS = "epoch_us(kafka_timestamp) // 1000"

_SPELLINGS = ", ".join(
    f"('{spelling}', '{code}')" for code, found in COUNTRY_SPELLINGS.items() for spelling in found
)
_CLEANED = f"""{_RAW}, spellings(spelling, code) AS (VALUES {_SPELLINGS}), judged AS (
  SELECT r.*,
    coalesce(s.code, upper(r.country)) AS country_code,
    trim(r.name) AS bare_name,
    r.age BETWEEN {AGE_LOW} AND {AGE_HIGH} AS age_fits,
    r.email LIKE '{EMAIL_LIKE}' AS email_fits
  FROM raw_users r LEFT JOIN spellings s ON s.spelling = upper(r.country)
), cleaned AS (
  SELECT coalesce(user_id, uuid) AS user_key, uuid, bare_name AS name,
    lower(trim(email)) AS email_normalized,
    if(age_fits, age, NULL) AS age_validated,
    country_code,
    TRY_CAST(fetched_at AS TIMESTAMP) AS fetched_timestamp,
    if(coalesce(age_fits AND email_fits AND bare_name <> '' AND country IS NOT NULL, false),
      '{VALID}', '{INVALID}') AS data_quality_status,
    source, api_version, {_MILLIS} AS processed_at, kafka_timestamp, "partition", "offset"
  FROM judged
)"""
_CLEANED_COLUMNS = (
    "user_key, uuid, name, email_normalized, age_validated, country_code, "
    "fetched_timestamp, data_quality_status, source, api_version, processed_at"
)
_VALID = f"{_CLEANED}, valid AS (SELECT * FROM cleaned WHERE data_quality_status = 'VALID')"

_SCORED = f"""{_RAW}, flagged AS (
  SELECT *,
    regexp_matches(email, '{EMAIL_REGEX}') AS is_valid_email,
    age IS NOT NULL AND age > 0 AND age < 120 AS is_valid_age,
    country IS NOT NULL AND length(trim(country)) > 0 AS is_valid_country,
    sha256(concat_ws('|', coalesce(user_id, ''), coalesce(uuid, ''), coalesce(fetched_at, '')))
      AS record_hash
  FROM raw_users
), pointed AS (
  SELECT *,
    CAST(CASE WHEN is_valid_email THEN 1 ELSE 0 END + CASE WHEN is_valid_age THEN 1 ELSE 0 END
      + CASE WHEN is_valid_country THEN 1 ELSE 0 END AS INT) AS data_quality_score
  FROM flagged
), scored AS (
  SELECT *, data_quality_score >= 2 AS is_complete FROM pointed
)"""
_SCORED_COLUMNS = (
    f'{_USER_COLUMNS}, kafka_timestamp, "offset", "partition", is_valid_email, is_valid_age, '
    "is_valid_country, data_quality_score, is_complete, record_hash"
)

_EVENT_DATE = "strftime(TRY_CAST(fetched_at AS TIMESTAMP), '%Y-%m-%d')"

_DAILY = f"""{_VALID}, daily AS (
  SELECT country_code,
    count(*) AS total_users,
    count(DISTINCT user_key) AS unique_users,
    round(avg(age_validated), 1) AS avg_age,
    min(age_validated) AS min_age,
    max(age_validated) AS max_age,
    strftime(date_trunc('day', kafka_timestamp), '%Y-%m-%d') AS event_date,
    max(processed_at) AS last_updated
  FROM valid GROUP BY country_code, date_trunc('day', kafka_timestamp)
)"""
_HOURLY = f"""{_VALID}, hourly AS (
  SELECT country_code,
    count(*) AS users_this_hour,
    count(DISTINCT user_key) AS unique_users_this_hour,
    round(avg(age_validated), 1) AS avg_age_this_hour,
    strftime(date_trunc('hour', kafka_timestamp), '%Y-%m-%d %H:00') AS hour_bucket,
    max(processed_at) AS last_updated
  FROM valid GROUP BY country_code, date_trunc('hour', kafka_timestamp)
)"""

_LOADED_TIME = (
    "make_timestamp(last_updated * 1000) AS last_updated_timestamp, 'ksqldb-gold' AS source"
)


def _latest(ignore_nulls: bool) -> str:
    columns = {
        "uuid": "uuid", "name": "name", "email": "email_normalized", "age": "age_validated",
        "country": "country_code", "last_seen": "fetched_timestamp",
        "last_processed": "processed_at",
    }
    order = 'ORDER BY kafka_timestamp DESC, "partition" DESC, "offset" DESC'
    picked = ", ".join(
        f"first({source} {order})"
        + (f" FILTER (WHERE {source} IS NOT NULL)" if ignore_nulls else "")
        + f" AS {name}"
        for name, source in columns.items()
    )
    return f"WITH {_VALID} SELECT user_key, {picked}, count(*) AS record_count FROM valid WHERE user_key IS NOT NULL GROUP BY user_key"


_CHANGELOG = f"""{_VALID}, steps AS (SELECT unnest([0, 1, 2]) AS batch_id), log AS (
  SELECT country_code,
    count(*) AS total_users,
    count(DISTINCT user_key) AS unique_users,
    strftime(date_trunc('day', kafka_timestamp), '%Y-%m-%d') AS event_date,
    max(processed_at) AS last_updated,
    batch_id
  FROM valid JOIN steps ON "partition" <= batch_id
  GROUP BY batch_id, country_code, date_trunc('day', kafka_timestamp)
  HAVING max("partition") = batch_id
)"""

_SENT = f"""{_VALID}, expected AS (
  SELECT coalesce(user_id, uuid) AS user_key, count(*) AS n FROM raw_users GROUP BY 1
), delivered AS (
  SELECT user_key, count(*) AS n FROM valid GROUP BY 1
)"""

_PACKED = "CAST(to_json(struct_pack({})) AS STRING)"
_KEY = "coalesce(nullif(user_id, ''), nullif(uuid, ''), sha256({}))".format(
    _PACKED.format(", ".join(f"{c} := {c}" for c in sorted(USER_EXPRESSIONS)))
)
_SPAN = "kafka_timestamp >= TIMESTAMP '2024-01-14 12:00:00' AND kafka_timestamp < TIMESTAMP '2024-01-16 12:00:00'"

_VALUE = _PACKED.format(", ".join(f"{c} := {c}" for c in USER_EXPRESSIONS))
_FAULTY = f"""{_RAW}, messages AS (
  SELECT *, {_VALUE} AS whole FROM raw_users
), sent AS (
  SELECT *, {FAULTY_VALUE.format(offset='"offset"', value="whole")} AS value FROM messages
), judged_messages AS (
  SELECT *, CASE WHEN coalesce(value, '') = '' THEN 'EMPTY_MESSAGE' WHEN value <> whole THEN 'MALFORMED_JSON' END AS error_type
  FROM sent
)"""
# Rows of the second half count where their day ends less than a day before the newest.
_ON_TIME = _DAILY.replace("FROM valid GROUP BY", """FROM valid
  WHERE "offset" % 2 = 0 OR date_trunc('day', kafka_timestamp) + INTERVAL 1 DAY
    > (SELECT max(kafka_timestamp) - INTERVAL 1 DAY FROM valid WHERE "offset" % 2 = 0)
  GROUP BY""")

ORACLES: dict[str, str] = {
    "malformed_messages": f"""WITH {_FAULTY} SELECT coalesce(value, '') AS value, error_type, kafka_timestamp,
        "offset", "partition" FROM judged_messages WHERE error_type IS NOT NULL""",
    "stream_malformed_messages": f"""WITH {_FAULTY} SELECT "offset",
        CASE WHEN error_type IS NULL THEN username END AS username, error_type FROM judged_messages""",
    "unique_records": f"""WITH {_SCORED} SELECT record_hash, "offset", user_id, uuid, fetched_at FROM scored
        QUALIFY row_number() OVER (PARTITION BY record_hash ORDER BY kafka_timestamp, "partition", "offset") = 1""",
    "stream_unique_records": f"""WITH {_SCORED} SELECT DISTINCT record_hash,
        coalesce(user_id, '') AS user_id, coalesce(uuid, '') AS uuid, coalesce(fetched_at, '') AS fetched_at FROM scored""",
    "stream_late_rows": f"WITH {_ON_TIME} SELECT * FROM daily",
    "normalise_records": f"""SELECT {_list({
        "user_id": API_EXPRESSIONS["id"],
        **{k: v for k, v in API_EXPRESSIONS.items() if k != "id"},
        **{k: "CAST(NULL AS STRING)" for k in (
            "dob cell address street_address postal_code longitude company_email mac_address "
            "user_agent timezone locale picture avatar"
        ).split()},
        "source": "'api-ninjas-randomuser'",
        "api_version": "'v2'",
    })} FROM events""",
    "message_key": f'WITH {_RAW} SELECT "offset", {_KEY} AS key FROM raw_users',
    "encode_messages": f"""WITH {_RAW} SELECT {_KEY} AS key,
        {_PACKED.format(", ".join(f"{c} := {c}" for c in USER_EXPRESSIONS))} AS value FROM raw_users""",
    "decode_envelope": f'WITH {_RAW} SELECT {_USER_COLUMNS}, kafka_timestamp, "offset", "partition" FROM raw_users',
    "bronze_enrich": f"""WITH {_RAW} SELECT {_USER_COLUMNS}, kafka_timestamp, "offset", "partition",
        kafka_timestamp AS ingested_at, {_EVENT_DATE} AS event_date, '0' AS batch_id FROM raw_users""",
    "lookback_window": f"""WITH {_RAW} SELECT "offset", user_id, kafka_timestamp AS ingested_at FROM raw_users
        WHERE kafka_timestamp >= TIMESTAMP '2024-01-15 12:00:00' - INTERVAL 1 HOUR""",
    "dq_flags": f'WITH {_SCORED} SELECT "offset", is_valid_email, is_valid_age, is_valid_country FROM scored',
    "dq_score": f'WITH {_SCORED} SELECT "offset", data_quality_score, is_complete FROM scored',
    "dq_summary": f"""WITH {_SCORED} SELECT count(*) AS records,
        count(*) FILTER (WHERE is_complete) AS complete,
        count(*) FILTER (WHERE NOT is_complete) AS quarantined,
        count(*) FILTER (WHERE is_valid_email) AS valid_email,
        count(*) FILTER (WHERE is_valid_age) AS valid_age,
        count(*) FILTER (WHERE is_valid_country) AS valid_country FROM scored""",
    "silver_complete": f"WITH {_SCORED} SELECT {_SCORED_COLUMNS} FROM scored WHERE is_complete",
    "quarantine_rows": f"WITH {_SCORED} SELECT {_SCORED_COLUMNS} FROM scored WHERE NOT is_complete",
    "record_hash": f'WITH {_SCORED} SELECT "offset", record_hash FROM scored',
    "clean_users": f"WITH {_CLEANED} SELECT {_CLEANED_COLUMNS} FROM cleaned",
    "record_key": f'WITH {_CLEANED} SELECT "offset", user_key FROM cleaned',
    "clean_text": f'WITH {_CLEANED} SELECT "offset", name, email_normalized FROM cleaned',
    "age_validated": f'WITH {_CLEANED} SELECT "offset", age_validated FROM cleaned',
    "canonical_country": f'WITH {_CLEANED} SELECT "offset", country_code FROM cleaned',
    "fetched_timestamp": f'WITH {_CLEANED} SELECT "offset", fetched_timestamp FROM cleaned',
    "strict_status": f'WITH {_CLEANED} SELECT "offset", data_quality_status FROM cleaned',
    "valid_users_stream": f"WITH {_VALID} SELECT {_CLEANED_COLUMNS} FROM valid",
    "invalid_dlq": f"""WITH {_CLEANED} SELECT {_CLEANED_COLUMNS}, 'INVALID_RECORD' AS error_type,
        processed_at AS rejected_at FROM cleaned WHERE data_quality_status = 'INVALID'""",
    "latest_users": _latest(ignore_nulls=True),
    "latest_users_with_nulls": _latest(ignore_nulls=False),
    "daily_country_stats": f"WITH {_DAILY} SELECT * FROM daily",
    "hourly_country_stats": f"WITH {_HOURLY} SELECT * FROM hourly",
    "daily_from_hourly_rollup": f"WITH {_DAILY} SELECT * FROM daily",
    "load_gold": f"""WITH {_DAILY} SELECT country_code AS "COUNTRY_CODE", total_users AS "TOTAL_USERS",
        unique_users AS "UNIQUE_USERS", avg_age AS "AVG_AGE", min_age AS "MIN_AGE", max_age AS "MAX_AGE",
        event_date AS "EVENT_DATE", {_LOADED_TIME} FROM daily""",
    "load_gold_hourly": f"""WITH {_HOURLY} SELECT country_code AS "COUNTRY_CODE",
        users_this_hour AS "USERS_THIS_HOUR", unique_users_this_hour AS "UNIQUE_USERS_THIS_HOUR",
        avg_age_this_hour AS "AVG_AGE_THIS_HOUR", hour_bucket AS "HOUR_BUCKET", {_LOADED_TIME} FROM hourly""",
    "gold_changelog": f"WITH {_CHANGELOG} SELECT * FROM log",
    "current_gold": f"""WITH {_CHANGELOG} SELECT country_code, total_users, unique_users, event_date,
        last_updated FROM log
        QUALIFY row_number() OVER (PARTITION BY country_code, event_date
                                   ORDER BY batch_id DESC, last_updated DESC) = 1""",
    "reconcile_counts": f"""WITH {_VALID}, counts AS (
          SELECT (SELECT count(*) FROM raw_users) AS expected, (SELECT count(*) FROM valid) AS sent
        ) SELECT expected, sent, expected = sent AS matched FROM counts""",
    "missing_keys": f"""WITH {_SENT} SELECT coalesce(e.user_key, d.user_key) AS user_key,
        coalesce(e.n, 0) AS expected, coalesce(d.n, 0) AS sent
        FROM expected e FULL OUTER JOIN delivered d ON e.user_key IS NOT DISTINCT FROM d.user_key
        WHERE coalesce(e.n, 0) <> coalesce(d.n, 0)""",
    "relation_sizes": f"""WITH {_VALID}
        SELECT 'raw_users_stream' AS relation, count(*) AS n_rows FROM raw_users
        UNION ALL SELECT 'cleaned_users_stream', count(*) FROM cleaned
        UNION ALL SELECT 'valid_users_stream', count(*) FROM valid
        UNION ALL SELECT 'valid_users_table', count(DISTINCT user_key) FROM valid
        UNION ALL SELECT 'invalid_users_dlq', count(*) FROM cleaned WHERE data_quality_status = 'INVALID'
        UNION ALL SELECT 'gold_daily_country_stats', count(*) FROM
          (SELECT DISTINCT country_code, date_trunc('day', kafka_timestamp) FROM valid)
        UNION ALL SELECT 'gold_hourly_stats', count(*) FROM
          (SELECT DISTINCT country_code, date_trunc('hour', kafka_timestamp) FROM valid)""",
    "stream_daily_country_stats": f"WITH {_DAILY} SELECT * FROM daily",
    "stream_hourly_country_stats": f"WITH {_HOURLY} SELECT * FROM hourly",
    "stream_latest_users": _latest(ignore_nulls=True),
    "stream_dead_letters": f"""WITH {_CLEANED} SELECT {_CLEANED_COLUMNS}, 'INVALID_RECORD' AS error_type,
        processed_at AS rejected_at FROM cleaned WHERE data_quality_status = 'INVALID'""",
    "stream_bronze_users": f"""WITH {_RAW} SELECT {_USER_COLUMNS}, kafka_timestamp, "offset", "partition",
        {_EVENT_DATE} AS event_date FROM raw_users""",
    "stream_silver_users": f"""WITH {_SCORED} SELECT "offset", {_EVENT_DATE} AS event_date, data_quality_score, record_hash,
        CASE WHEN is_complete THEN 'silver_users' ELSE 'silver_quarantine' END AS table_name FROM scored""",
}
ORACLES |= {
    # The same rows by other ways: files and topics read back, replays, compacted logs.
    "record_files": ORACLES["normalise_records"],
    "sent_messages": f"WITH {_RAW} SELECT {_USER_COLUMNS} FROM raw_users",
    "reconcile_delivered": f"""WITH {_RAW} SELECT count(*) AS expected, count(*) AS sent, true AS matched
        FROM raw_users""",
    "silver_batch_runs": f"""WITH {_SCORED} SELECT "offset", data_quality_score, is_complete, record_hash FROM scored
        WHERE {_SPAN}""",
    "stream_replay_gold": ORACLES["daily_country_stats"],
    "stream_gold_both": ORACLES["hourly_country_stats"],
    "stream_new_checkpoint": ORACLES["daily_country_stats"],
    "stream_merged_gold": ORACLES["daily_country_stats"],
    "stream_merged_latest_users": ORACLES["latest_users"],
    "stream_gold_messages": ORACLES["load_gold"],
    "compacted_latest_users": ORACLES["latest_users"],
}
