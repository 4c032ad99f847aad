import re

import pytest

import __spark_entry__ as contract
import check_oracles
from tierflow.plans.catalog import QUERIES
from tierflow.plans.oracles import ORACLES

STREAMS = sorted(name for name in QUERIES if name.startswith("stream_"))
#: Queries that store something and read it back: their last plan is only a scan of it.
STORED = {"compacted_latest_users", "record_files", "sent_messages"}
BATCH = sorted(set(QUERIES) - set(STREAMS) - STORED)


@pytest.fixture(scope="module")
def con(sf_dir):
    return check_oracles.connect(sf_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_flagship(spark, sf_dir):
    assert contract.entry(spark).count() == 146


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, sf_dir, con, name):
    assert check_oracles.compare(spark, con, sf_dir, name) is None


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_plans_hold_at_scale(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange", "Python", "Window "):
        assert bad not in text
    # One task only ever gets the partial sums of a global aggregate.
    if "SinglePartition" in text:
        assert name in {"dq_summary", "reconcile_counts", "reconcile_delivered", "relation_sizes"}
    scanned = [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<([^>]*)>", text)]
    assert scanned and all("value" not in s for s in scanned)


def test_gold_scan_reads_three_columns_and_shuffles_twice(spark, sf_dir):
    text = plan(QUERIES["daily_country_stats"](spark, sf_dir))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in text
    assert text.count("Exchange hashpartitioning") == 2
    first, second = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)[::-1]
    assert "user_key" in first and "user_key" not in second


def test_latest_shuffles_once_after_combining(spark, sf_dir):
    text = plan(QUERIES["latest_users"](spark, sf_dir))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_max_by" in text[text.index("Exchange") :]
