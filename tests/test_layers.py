import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tierflow.operators.bronze import recent, to_bronze
from tierflow.operators.gold import (
    DAILY,
    HOURLY,
    coarsen_rollup,
    country_stats,
    current_gold,
    load_gold,
    stats_from_rollup,
    user_rollup,
)
from tierflow.operators.latest import latest_users
from tierflow.operators.messages import encode_gold
from tierflow.operators.quality import quality_summary, score_quality, split_by_quality
from tierflow.operators.reconcile import missing_keys, reconcile_counts, report_delivery
from tierflow.operators.silver import clean_users, invalid_users, valid_users
from tierflow.plans import inputs
from tierflow.schemas import BRONZE_SCHEMA, SILVER_SCHEMA
from tierflow.sources.relations import list_relations, register_relations

T0 = dt.datetime(2024, 1, 2, 3, 4, 5)


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


def random_users(users, n=400, seed=1):
    rng = random.Random(seed)
    return users(
        *(
            {
                # One user holds a third of the rows.
                "user_id": "hot" if rng.random() < 1 / 3 else rng.choice([None, "", "1", "2", "3", "4"]),
                "uuid": rng.choice([None, "u1", "u2"]),
                "name": rng.choice([" A ", "B", " "]),
                "age": rng.choice([None, -1, 0, 18, 64, 120, 121]),
                "country": rng.choice(["th", "USA", "uk", "", "de", None]),
                "fetched_at": rng.choice(["2024-01-02T00:00:00", "bad", None]),
                "kafka_timestamp": T0 + dt.timedelta(minutes=rng.randrange(4000)),
                "partition": rng.randrange(3),
            }
            for _ in range(n)
        )
    )


def test_bronze_columns_and_lineage(spark, users, tmp_path):
    path = str(tmp_path / "in")
    users({}, {"fetched_at": "bad"}).write.parquet(path)
    bronze = to_bronze(spark.read.parquet(path), 7)
    rows = bronze.orderBy("offset").collect()
    assert [r.event_date for r in rows] == ["2024-01-02", None]
    assert {r.batch_id for r in rows} == {"7"}
    assert all(path in r.source_file for r in rows)
    assert BRONZE_SCHEMA.fieldNames()[-4:] == bronze.columns[-4:]
    assert len(BRONZE_SCHEMA) == 26 and len(SILVER_SCHEMA) == 33


def test_lookback_reaches_the_scan(spark, users, tmp_path):
    path = str(tmp_path / "bronze")
    to_bronze(users({}), 0).write.parquet(path)
    assert recent(spark.read.parquet(path)).count() == 1
    plan = recent(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ingested_at), GreaterThanOrEqual(ingested_at" in plan
    bound = F.lit(T0)
    df = users({"kafka_timestamp": T0 - dt.timedelta(hours=1)}, {"kafka_timestamp": T0 - dt.timedelta(hours=1, microseconds=1)})
    df = to_bronze(df, 0, ingested_at=F.col("kafka_timestamp").cast("timestamp"))
    assert [r.offset for r in recent(df, bound.cast("timestamp")).collect()] == [0]


@pytest.mark.parametrize(
    "change, score",
    [({}, 3), ({"email": None}, 2), ({"email": "x"}, 2), ({"email": None, "age": 120}, 1),
     ({"email": None, "age": 0, "country": " "}, 0), ({"name": None}, 3)],
)
def test_score(users, change, score):
    row = score_quality(users(change)).first()
    assert row.data_quality_score == score
    assert row.is_complete is (score >= 2)


def test_split_keeps_every_row(users):
    scored = score_quality(random_users(users))
    complete, rejected = split_by_quality(scored)
    summary = quality_summary(scored).first()
    assert summary.records == 400 == summary.complete + summary.quarantined
    assert (complete.count(), rejected.count()) == (summary.complete, summary.quarantined)


def test_cleaned_rows_split_into_valid_and_dead_letters(users):
    cleaned = clean_users(random_users(users))
    dead = invalid_users(cleaned)
    assert len(cleaned.columns) == 11 and len(dead.columns) == 13
    assert valid_users(cleaned).count() + dead.count() == 400
    assert dead.filter((F.col("error_type") != "INVALID_RECORD") | (F.col("rejected_at") != F.col("processed_at"))).isEmpty()


def newest_by_hand(rows, ignore_nulls):
    groups = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.kafka_timestamp, r.partition, r.offset)):
        if r.data_quality_status == "VALID" and r.user_key is not None:
            groups[r.user_key].append(r)
    fields = ("uuid", "name", "email_normalized", "age_validated", "country_code", "fetched_timestamp", "processed_at")
    out = []
    for key, members in groups.items():
        picked = []
        for f in fields:
            values = [r[f] for r in members if r[f] is not None or not ignore_nulls]
            picked.append(values[-1] if values else None)
        out.append((key, *picked, len(members)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("ignore_nulls", [True, False])
def test_latest_users_against_brute_force(users, ignore_nulls):
    cleaned = clean_users(random_users(users), keep_envelope=True)
    assert bag(latest_users(cleaned, ignore_nulls)) == newest_by_hand(cleaned.collect(), ignore_nulls)


def test_latest_breaks_ties_by_partition_then_offset(users):
    df = users({"name": "a", "partition": 1, "offset": 1}, {"name": "b", "partition": 0, "offset": 9}, {"name": "c", "partition": 1, "offset": 0})
    assert latest_users(clean_users(df, keep_envelope=True)).first().name == "a"


def stats_by_hand(rows, width):
    groups = defaultdict(list)
    for r in rows:
        if r.data_quality_status == "VALID":
            stamp = str(r.kafka_timestamp)[:width] + (":00" if width == 13 else "")
            groups[(r.country_code, stamp)].append(r)
    out = []
    for (country, stamp), members in groups.items():
        ages = [r.age_validated for r in members]
        users_seen = {r.user_key for r in members} - {None}
        limits = (min(ages), max(ages)) if width == 10 else ()
        mean = float(int(sum(ages) / len(ages) * 10 + 0.5)) / 10
        out.append((country, len(members), len(users_seen), mean, *limits, stamp, max(r.processed_at for r in members)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("shape, width", [(DAILY, 10), (HOURLY, 13)])
def test_gold_against_brute_force(users, shape, width):
    cleaned = clean_users(random_users(users), keep_envelope=True)
    assert bag(country_stats(valid_users(cleaned), shape)) == stats_by_hand(cleaned.collect(), width)


def test_daily_from_hourly_equals_daily(users):
    valid = valid_users(clean_users(random_users(users), keep_envelope=True))
    rolled = stats_from_rollup(coarsen_rollup(user_rollup(valid, "1 hour"), "1 day"), DAILY)
    assert bag(rolled) == bag(country_stats(valid, DAILY))


@pytest.mark.parametrize("name", ["UTC", "America/New_York"])
def test_gold_of_instants_uses_utc_days(users, zone, name):
    zone(name)
    raw = users({"kafka_timestamp": dt.datetime(2024, 1, 2, 0, 0)}, {"kafka_timestamp": dt.datetime(2024, 1, 1, 23, 59)})
    for df in (raw, inputs.as_instants(raw)):
        stats = country_stats(valid_users(clean_users(df, keep_envelope=True)), DAILY)
        assert sorted(r.event_date for r in stats.collect()) == ["2024-01-01", "2024-01-02"]


def test_gold_of_nothing_is_empty(users):
    valid = valid_users(clean_users(users({"age": None}), keep_envelope=True))
    assert country_stats(valid, DAILY).isEmpty()


def test_load_gold_decodes_messages(spark, users, zone):
    valid = valid_users(clean_users(users({}), keep_envelope=True))
    loaded = load_gold(encode_gold(country_stats(valid, HOURLY)), HOURLY)
    assert loaded.columns == [
        "COUNTRY_CODE", "USERS_THIS_HOUR", "UNIQUE_USERS_THIS_HOUR", "AVG_AGE_THIS_HOUR", "HOUR_BUCKET",
        "last_updated_timestamp", "ingested_at", "source",
    ]
    row = loaded.first()
    assert (row.COUNTRY_CODE, row.HOUR_BUCKET, row.source) == ("TH", "2024-01-02 03:00", "ksqldb-gold")
    assert loaded.select(F.unix_millis("last_updated_timestamp")).first()[0] == 1704164645000


def test_current_gold_prefers_the_later_batch_over_the_later_time(spark):
    log = spark.createDataFrame(
        [("TH", "2024-01-01", 1, 50, "9"), ("TH", "2024-01-01", 2, 40, "10"), ("US", "2024-01-01", 7, 1, "0")],
        "country_code string, event_date string, total_users long, last_updated long, batch_id string",
    )
    assert bag(current_gold(log, DAILY)) == [("TH", "2024-01-01", 2, 40), ("US", "2024-01-01", 7, 1)]


def test_reconcile(spark, users):
    three, two, none = users({}, {}, {}), users({}, {}), users({}).limit(0)
    assert tuple(reconcile_counts(three, two).first()) == (3, 2, False)
    assert tuple(reconcile_counts(two, two).first()) == (2, 2, True)
    assert tuple(reconcile_counts(none, none).first()) == (0, 0, True)
    left = users({"user_id": "a"}, {"user_id": "a"}, {"user_id": None}, {"user_id": "b"})
    right = users({"user_id": "a"}, {"user_id": "b"}, {"user_id": "c"})
    assert bag(missing_keys(left, right, "user_id")) == sorted([("a", 2, 1), (None, 1, 0), ("c", 0, 1)], key=repr)


@pytest.mark.parametrize("expected, sent, matched", [(2, 2, True), (3, 2, False), (None, None, False), (0, 0, True)])
def test_report_warns_and_never_fails(caplog, expected, sent, matched):
    with caplog.at_level("INFO"):
        assert report_delivery(expected, sent) is matched
    assert ("Delivery mismatch" in caplog.text) is not matched


def test_named_relations(spark, users):
    names = register_relations(users({}, {"age": None}))
    assert set(names) <= set(list_relations(spark))
    assert spark.sql("SELECT * FROM cleaned_users_stream").count() == 2
    assert spark.sql("SELECT user_key, record_count FROM valid_users_table").first().record_count == 1
    assert spark.sql("SELECT error_type FROM invalid_users_dlq").first()[0] == "INVALID_RECORD"
    assert spark.sql("SELECT total_users FROM gold_daily_country_stats").first()[0] == 1
    for name in names:
        spark.catalog.dropTempView(name)
