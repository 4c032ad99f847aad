"""Deployment settings, one value per matter, read from the environment or given."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Settings:
    #: Brokers; needed by the ``kafka`` message format only.
    bootstrap: str | None = None
    topic: str = "Raw_Data"
    message_format: str = "kafka"
    message_options: Mapping[str, str] = field(default_factory=dict)
    table_format: str = "parquet"
    table_options: Mapping[str, str] = field(default_factory=dict)
    #: Root folder of the layer tables, one that all executors share. The layers
    #: follow each other's tables, so these are files.
    table_root: str | None = None
    #: Format, options and root (such as ``project.dataset``) of the tables handed
    #: outward: silver, quarantine, dead letters, latest users and gold. Layer
    #: tables unless given.
    outward_format: str | None = None
    outward_options: Mapping[str, str] = field(default_factory=dict)
    outward_root: str | None = None
    #: Shared folder for checkpoints; each query takes its own folder below it.
    checkpoint_root: str | None = None
    trigger: Mapping[str, object] = field(default_factory=lambda: {"processingTime": "1 minute"})
    #: Bytes of files that a query takes at a time: of a followed table whole batches, of
    #: a folder of messages whole files, but at least one. No bound unless set.
    max_bytes: int | None = None
    #: Set messages aside that are no JSON object, instead of keeping rows of nulls.
    split_malformed: bool = False
    #: Drop repeats of a record that come within this span of message time.
    unique_within: str | None = None
    #: What happens when a query with a checkpoint of its own finds batches of another in
    #: its table: ``fail``, or ``continue`` after the newest of them.
    takeover: str = "fail"
    #: Bound on lateness in gold; ``None`` accepts all late rows and keeps all state.
    watermark: str | None = None

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, **overrides: object) -> Settings:
        env = os.environ if env is None else env
        names = {
            "bootstrap": "KAFKA_BOOTSTRAP",
            "topic": "KAFKA_TOPIC",
            "table_root": "TABLE_ROOT",
            "checkpoint_root": "CHECKPOINT_LOCATION",
        }
        found = {name: env[key] for name, key in names.items() if env.get(key)}
        return cls(**{**found, **overrides})
