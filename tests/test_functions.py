import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tierflow.functions import checks, keys, text, times


def column(df, expr):
    return [r[0] for r in df.select(expr).collect()]


@pytest.mark.parametrize(
    "age, in_range, flag",
    [(-1, False, False), (0, True, False), (1, True, True), (119, True, True),
     (120, True, False), (121, False, False), (None, None, False)],
)
def test_age_limits_differ_between_policies(users, age, in_range, flag):
    df = users({"age": age})
    assert column(df, checks.age_in_range(F.col("age"))) == [in_range]
    assert column(df, checks.age_flag()) == [flag]
    assert column(df, checks.age_or_null(F.col("age"))) == [age if in_range else None]


@pytest.mark.parametrize(
    "email, flag, status",
    [("a@b.co", True, "VALID"), (" A@B.CO ", False, "VALID"), ("broken@", False, "INVALID"),
     ("a@b.c", False, "VALID"), ("a.b@c", False, "INVALID"), ("", False, "INVALID"),
     (None, None, "INVALID"), ("@.", False, "VALID"), ("x" * 5000 + "@b.co", True, "VALID")],
)
def test_email_checks(users, email, flag, status):
    df = users({"email": email})
    assert column(df, checks.email_flag()) == [flag]
    assert column(df, checks.strict_status()) == [status]


@pytest.mark.parametrize(
    "country, code, flag, status",
    [("Thailand", "TH", True, "VALID"), ("th", "TH", True, "VALID"), ("usa", "US", True, "VALID"),
     ("United States", "US", True, "VALID"), ("uk", "GB", True, "VALID"), ("GB", "GB", True, "VALID"),
     ("united kingdom", "GB", True, "VALID"), ("de", "DE", True, "VALID"), (" th", " TH", True, "VALID"),
     ("", "", False, "VALID"), ("  ", "  ", False, "VALID"), (None, None, False, "INVALID")],
)
def test_country(users, country, code, flag, status):
    df = users({"country": country})
    assert column(df, text.canonical_country(F.col("country"))) == [code]
    assert column(df, checks.country_flag()) == [flag]
    assert column(df, checks.strict_status()) == [status]


@pytest.mark.parametrize(
    "change, status",
    [({}, "VALID"), ({"name": "   "}, "INVALID"), ({"name": None}, "INVALID"), ({"name": ""}, "INVALID"),
     ({"age": None}, "INVALID"), ({"age": 0}, "VALID"), ({"age": 120}, "VALID"), ({"age": 121}, "INVALID")],
)
def test_strict_status_treats_unknown_as_invalid(users, change, status):
    assert column(users(change), checks.strict_status()) == [status]


def test_record_key_and_message_key_differ_on_empty_text(users):
    df = users({"user_id": ""}, {"user_id": None}, {"user_id": "7"}, {"user_id": None, "uuid": None})
    assert column(df, keys.record_key()) == ["", "u-1", "7", None]
    found = column(df, keys.message_key(["user_id", "uuid", "email"]))
    assert found[:3] == ["u-1", "u-1", "7"]
    body = json.dumps({"email": "a@b.co", "user_id": None, "uuid": None}, sort_keys=True, separators=(",", ":"))
    assert found[3] == hashlib.sha256(body.encode()).hexdigest()


def test_record_hash_keeps_slots_of_nulls(users):
    df = users({"user_id": None}, {"user_id": "1", "uuid": None, "fetched_at": None})
    expected = ["|u-1|2024-01-02T03:04:05", "1||"]
    assert column(df, keys.record_hash()) == [hashlib.sha256(t.encode()).hexdigest() for t in expected]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_text_that_is_no_time_gives_null(spark, users, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = users({"fetched_at": "not-a-date"}, {"fetched_at": None}, {"fetched_at": ""}, {})
        assert column(df, times.parsed_date(F.col("fetched_at"))) == [None, None, None, "2024-01-02"]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("name", ["UTC", "America/New_York", "Asia/Bangkok"])
def test_times_do_not_depend_on_the_session_zone(spark, zone, name):
    zone(name)
    wall = dt.datetime(2024, 3, 10, 23, 59, 59, 999999)
    df = spark.createDataFrame([(wall,)], "t timestamp_ntz")
    df = df.withColumn("i", times.ntz_as_utc(F.col("t")))
    millis = int(wall.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    row = df.select(
        times.epoch_millis(df, "t").alias("a"), times.epoch_millis(df, "i").alias("b"),
        times.utc_ntz(F.col("i")).alias("back"),
        times.day_label(df, "t").alias("d1"), times.day_label(df, "i").alias("d2"),
        times.hour_label(df, "t").alias("h1"), times.hour_label(df, "i").alias("h2"),
        times.millis_to_ntz(F.lit(millis)).alias("ntz"),
    ).first()
    assert (row.a, row.b, row.back) == (millis, millis, wall)
    assert row.d1 == row.d2 == "2024-03-10"
    assert row.h1 == row.h2 == "2024-03-10 23:00"
    assert row.ntz == wall.replace(microsecond=999000)


def test_stamp_is_iso(spark):
    stamp = spark.range(1).select(times.stamp_now()).first()[0]
    assert dt.datetime.fromisoformat(stamp)
