"""The layers as named relations for SQL users."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.checks import VALID
from tierflow.operators.gold import DAILY, HOURLY, country_stats
from tierflow.operators.latest import latest_users
from tierflow.operators.silver import ENVELOPE, clean_users, invalid_users, valid_users


def relations(raw: DataFrame) -> dict[str, DataFrame]:
    """Every relation derived from raw users, under its SQL name."""
    ordered = clean_users(raw, keep_envelope=True)
    valid = valid_users(ordered)
    cleaned = ordered.drop(*ENVELOPE)
    return {
        "raw_users_stream": raw,
        "cleaned_users_stream": cleaned,
        "valid_users_stream": valid.drop(*ENVELOPE),
        "valid_users_table": latest_users(ordered),
        "invalid_users_dlq": invalid_users(cleaned),
        DAILY.name: country_stats(valid, DAILY),
        HOURLY.name: country_stats(valid, HOURLY),
    }


def relation_sizes(raw: DataFrame) -> DataFrame:
    """(relation, n_rows) of all relations from one pass over the records: a rollup by
    hour, country, user and status holds everything that is counted."""
    ordered = clean_users(raw, keep_envelope=True)
    hour = F.date_trunc("hour", "kafka_timestamp").alias("hour")
    rolled = ordered.groupBy("data_quality_status", "country_code", "user_key", hour).agg(F.count(F.lit(1)).alias("n"))
    valid = F.col("data_quality_status") == VALID
    day = F.date_trunc("day", "hour")
    sizes = {
        "raw_users_stream": F.sum("n"),
        "cleaned_users_stream": F.sum("n"),
        "valid_users_stream": F.sum(F.when(valid, F.col("n"))),
        "valid_users_table": F.countDistinct(F.when(valid, F.col("user_key"))),
        "invalid_users_dlq": F.sum(F.when(~valid, F.col("n"))),
        DAILY.name: F.countDistinct(F.when(valid, F.struct("country_code", day))),
        HOURLY.name: F.countDistinct(F.when(valid, F.struct("country_code", "hour"))),
    }
    counted = rolled.agg(*(F.coalesce(size, F.lit(0)).alias(name) for name, size in sizes.items()))
    pairs = (F.struct(F.lit(name).alias("relation"), F.col(name).alias("n_rows")) for name in sizes)
    return counted.select(F.inline(F.array(*pairs)))


def register_relations(raw: DataFrame) -> list[str]:
    """Temporary views over ``raw``; each is planned only when it is queried."""
    found = relations(raw)
    for name, df in found.items():
        df.createOrReplaceTempView(name)
    return list(found)


def list_relations(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables())


def list_streams(spark: SparkSession) -> list[str]:
    return sorted(q.name or str(q.id) for q in spark.streams.active)
