import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tierflow.batch import gold_batch, silver_batch
from tierflow.operators.bronze import INGEST_DATE, recent, to_bronze
from tierflow.operators.gold import DAILY, HOURLY, country_stats
from tierflow.operators.log import compact_log, current_rows
from tierflow.operators.quality import score_quality
from tierflow.operators.silver import clean_users, valid_users
from tierflow.schemas import BRONZE_SCHEMA, SILVER_SCHEMA
from tierflow.session import shared_dir, work_dir
from tierflow.sinks.tables import Target, append_table, remove_folder, write_batch
from tierflow.sources.tables import read_table
from tierflow.streaming.jobs import table_name, target
from tierflow.streaming.writers import bronze_writer, silver_writer, table_writer


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_append_partitions_by_date(spark, users, tmp_path):
    dated = to_bronze(users({}, {"fetched_at": "2024-02-01T00:00:00"}, {"fetched_at": "bad"}), 0)
    place = Target(str(tmp_path / "t"), partition_by=("event_date",), rebalance=True)
    append_table(dated, place)
    append_table(dated, place)
    assert spark.read.parquet(place.name).count() == 6
    folders = {d for d in os.listdir(place.name) if d.startswith("event_date")}
    assert folders == {"event_date=2024-01-02", "event_date=2024-02-01", "event_date=__HIVE_DEFAULT_PARTITION__"}
    files = [f for d in folders for f in os.listdir(f"{place.name}/{d}") if f.endswith(".snappy.parquet")]
    assert len(files) == 6
    pruned = spark.read.parquet(place.name).filter("event_date = '2024-02-01'")
    assert "PartitionFilters: [isnotnull(event_date" in pruned._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_a_batch_written_again_changes_nothing(spark, users, tmp_path, fmt):
    place = Target(str(tmp_path / "t"), fmt)
    for batch in (0, 1, 1, 0):
        write_batch(users({"name": f"n{batch}"}, {}), place, batch)
    assert read_table(spark, place.name, fmt).groupBy("batch_id").count().orderBy("batch_id").collect() == [(0, 2), (1, 2)]


def test_bronze_replay_and_text_batch_id(spark, users, tmp_path):
    place = Target(str(tmp_path / "bronze"), partition_by=("event_date",))
    write = bronze_writer(place)
    for batch in (9, 10, 10):
        write(users({}, {"fetched_at": "bad"}), batch)
    table = read_table(spark, place.name, schema=BRONZE_SCHEMA)
    assert table.count() == 4
    assert sorted({r.batch_id for r in table.collect()}) == ["10", "9"]


def test_silver_quarantine_has_its_own_table(spark, users, tmp_path):
    complete, quarantine = Target(str(tmp_path / "ok")), Target(str(tmp_path / "bad"))
    write = silver_writer(complete, quarantine)
    bronze = to_bronze(users({}, {"age": None}, {"age": None, "country": None}), 5)
    write(score_quality(bronze), 0)
    # The same bronze batch in a later micro-batch must not replace the first part.
    write(score_quality(bronze), 1)
    write(score_quality(bronze), 1)
    ok = read_table(spark, complete.name, schema=SILVER_SCHEMA)
    bad = read_table(spark, quarantine.name, schema=SILVER_SCHEMA)
    assert (ok.count(), bad.count()) == (4, 2)
    assert ok.filter(~F.col("is_complete")).isEmpty() and bad.filter("is_complete").isEmpty()


def test_nothing_to_quarantine_writes_no_rows(spark, users, tmp_path):
    complete, quarantine = Target(str(tmp_path / "ok")), Target(str(tmp_path / "bad"))
    silver_writer(complete, quarantine)(score_quality(to_bronze(users({}), 0)), 0)
    assert not [d for d in os.listdir(quarantine.name) if d.startswith("load_id")]


def test_a_connector_gets_its_options_and_no_empty_batches(users, monkeypatch):
    from pyspark.sql import DataFrameWriter

    seen = []
    monkeypatch.setattr(DataFrameWriter, "save", lambda self, *a: seen.append(a))
    monkeypatch.setattr(DataFrameWriter, "option", lambda self, k, v: seen.append((k, v)) or self)
    place = Target("project.gold.daily", "warehouse", {"writeMethod": "direct"})
    write_batch(users({}).limit(0), place, 0)
    assert seen == []
    write_batch(users({}), place, 0)
    assert seen == [("table", "project.gold.daily"), ()]


def test_sample_rows_are_printed(users, tmp_path, capsys):
    table_writer(Target(str(tmp_path / "t")), sample=2)(users({"name": "one"}, {}, {"name": "three"}), 0)
    printed = capsys.readouterr().out
    assert "one" in printed and "three" not in printed


def test_silver_batch_runs_again_without_duplicates(spark, users, settings):
    bronze = to_bronze(users({}, {"age": None, "country": None}), 3)
    append_table(bronze, target(settings, "bronze_users", "event_date"))
    soon = dt.datetime.now(dt.timezone.utc) + dt.timedelta(minutes=5)
    for _ in range(2):
        silver_batch(spark, settings, soon.isoformat())
    silver_batch(spark, settings, "2999-01-01 00:00:00")
    assert silver_rows(spark, settings) == [(0, True), (1, False)]


def silver_rows(spark, settings):
    table = read_table(spark, table_name(settings, "silver_batch"), schema=SILVER_SCHEMA)
    return sorted((r.offset, r.is_complete) for r in table.collect())


def bronze_at(users, settings, *times):
    rows = users(*({"offset": i} for i in range(len(times))))
    ingested = F.element_at(F.array(*(F.lit(t).cast("timestamp") for t in times)), F.col("offset").cast("int") + 1)
    stamped = to_bronze(rows, 0, ingested).withColumn(INGEST_DATE, F.to_date("ingested_at"))
    append_table(stamped, target(settings, "bronze_users", INGEST_DATE))


def test_adjoining_spans_share_no_row(spark, users, settings):
    bronze_at(users, settings, "2024-01-15 11:59:59", "2024-01-15 12:00:00", "2024-01-16 11:59:59.999999")
    for as_of in ("2024-01-15 12:00:00", "2024-01-16 12:00:00"):
        silver_batch(spark, settings, as_of, "24 HOURS")
    assert silver_rows(spark, settings) == [(0, True), (1, True), (2, True)]


def test_the_instant_names_the_run(spark, users, settings):
    bronze_at(users, settings, "2024-01-15 11:30:00", "2024-11-05 11:30:00")
    # The digits of these two are the same; the third is another spelling of the first.
    for as_of in ("2024-1-15 12:00:00", "2024-11-5 12:00:00", "2024-01-15T13:00:00.000000+01:00"):
        silver_batch(spark, settings, as_of)
    assert silver_rows(spark, settings) == [(0, True), (1, True)]
    with pytest.raises(ValueError):
        silver_batch(spark, settings, "noon")


def test_a_rerun_replaces_all_rows_of_its_run(spark, users, settings):
    bronze_at(users, settings, "2024-01-15 11:30:00")
    silver_batch(spark, settings, "2024-01-15 12:00:00")
    remove_folder(spark, table_name(settings, "bronze_users"))
    bronze_at(users, settings, "2023-01-01 00:00:00")
    silver_batch(spark, settings, "2024-01-15 12:00:00")
    name = table_name(settings, "silver_batch")
    assert spark.read.schema(SILVER_SCHEMA).parquet(name).count() == 0


def test_the_look_back_reads_its_days_only(spark, users, settings):
    bronze_at(users, settings, "2024-01-14 00:00:00", "2024-01-15 11:30:00")
    table = read_table(spark, table_name(settings, "bronze_users"))
    plan = recent(table, F.lit("2024-01-15 12:00:00").cast("timestamp"), until=True)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in text and plan.count() == 1


def test_a_published_batch_keeps_its_files(spark, users, tmp_path):
    place = Target(str(tmp_path / "t"))
    write_batch(users({}), place, 0)
    files = sorted(os.listdir(f"{place.name}/batch_id=0"))
    write_batch(users({}, {}), place, 0)
    assert sorted(os.listdir(f"{place.name}/batch_id=0")) == files
    write_batch(users({}, {}), place, 0, replace=True)
    assert spark.read.parquet(place.name).count() == 2


def test_counts_on_connectors_are_those_of_the_write(spark, users, caplog):
    caplog.set_level("INFO")
    rows = users({}, {}, {"age": None, "country": None}).repartition(3)
    outward = Target("t", "noop")
    bronze_writer(outward)(rows, 0)
    assert "bronze batch 0: 3 records" in caplog.text
    silver_writer(outward, outward)(score_quality(to_bronze(rows, 0)), 0)
    assert "'records': 3" in caplog.text and "'complete': 2" in caplog.text


def test_compacted_log_reads_like_the_log(spark, tmp_path):
    rows = [("a", 1, 0), ("b", 1, 0), ("a", 2, 1), ("a", 3, 10), ("c", 1, 2)]
    log = spark.createDataFrame(rows, "key string, value int, batch_id long")
    place = Target(str(tmp_path / "t"))
    for _ in range(2):
        compact_log(log, place, ["key"], 10)
    compacted = spark.read.parquet(place.name)
    assert compacted.count() == 3
    assert bag(current_rows(compacted, ["key"])) == bag(current_rows(log, ["key"])) == [("a", 3), ("b", 1), ("c", 1)]


def test_gold_batch_builds_both_tables_from_one_rollup(spark, users, settings):
    cleaned = clean_users(users({}, {"age": 31}, {"user_id": "2", "country": "uk"}), keep_envelope=True)
    for _ in range(2):
        gold_batch(spark, cleaned, settings)
    for shape in (DAILY, HOURLY):
        built = read_table(spark, table_name(settings, shape.name))
        assert bag(built) == bag(country_stats(valid_users(cleaned), shape))


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value or default


class _Session:
    def __init__(self, value, master):
        self.conf = _Conf(value)
        self.sparkContext = type("Context", (), {"master": master})


def test_the_work_folder_is_the_one_the_cluster_names():
    session = _Session("hdfs://nn/shared/", "yarn")
    assert shared_dir(session) == "hdfs://nn/shared"
    assert work_dir(session, "x").startswith("hdfs://nn/shared/x-")
    assert work_dir(session, "x") != work_dir(session, "x")
    with pytest.raises(ValueError):
        shared_dir(_Session(None, "yarn"))
    assert os.path.isdir(shared_dir(_Session(None, "local[8]")))
