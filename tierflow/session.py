"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import SparkSession

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# Streaming state on local disk with checkpointed changes, not on the heap.
STATE = {
    PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Each is set only where the cluster has not set it.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # HotSpot never compiles methods above 8000 bytes of bytecode; past that size
    # a wide projection runs faster split up than as one interpreted method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    **STATE,
}

_changing = threading.Lock()


def create_session(app: str = "tierflow", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own:
    on a cluster other machines could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="run-")
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid4().hex}"


def check_session(spark: SparkSession) -> None:
    """Fail on a session whose settings would change results quietly."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"event dates are UTC days, but the session is in {zone}; use create_session")


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams that start in here keep their state on disk in any session.

    A stream copies the settings of its session when it starts, so those of the session
    come back afterwards.
    """
    with _changing:
        before = {key: spark.conf.get(key, None) for key in STATE}
        changed = {key: value for key, value in STATE.items() if key == PROVIDER or before[key] is None}
        try:
            for key, value in changed.items():
                spark.conf.set(key, value)
            yield
        finally:
            for key in changed:
                if before[key] is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, before[key])
