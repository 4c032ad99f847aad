"""Layered processing of user records on Spark: bronze, silver, gold."""

from tierflow.operators.bronze import recent, to_bronze
from tierflow.operators.gold import DAILY, HOURLY, country_stats, current_gold, load_gold
from tierflow.operators.latest import current_latest_users, latest_users
from tierflow.operators.log import compact_log, current_rows
from tierflow.operators.messages import decode_messages, encode_messages, split_malformed
from tierflow.operators.quality import quality_summary, score_quality, split_by_quality
from tierflow.operators.reconcile import missing_keys, reconcile_counts, report_delivery
from tierflow.operators.records import normalise_records
from tierflow.operators.silver import clean_users, invalid_users, valid_users
from tierflow.operators.unique import unique_records
from tierflow.session import create_session
from tierflow.settings import Settings
from tierflow.sources.relations import list_relations, list_streams, register_relations
from tierflow.streaming.jobs import await_any, layer_starters, maintain, run_layers
from tierflow.streaming.stats import stream_country_stats
from tierflow.streaming.supervision import LayerMonitor, supervise

__all__ = [
    "DAILY", "HOURLY", "LayerMonitor", "Settings", "await_any", "clean_users", "compact_log", "country_stats",
    "create_session", "current_gold", "current_latest_users", "current_rows", "decode_messages", "encode_messages",
    "invalid_users", "latest_users", "layer_starters", "list_relations", "list_streams", "load_gold",
    "maintain", "missing_keys", "normalise_records", "quality_summary", "recent",
    "reconcile_counts", "register_relations", "report_delivery", "run_layers",
    "score_quality", "split_by_quality", "split_malformed", "stream_country_stats", "supervise", "to_bronze", "unique_records", "valid_users",
]
