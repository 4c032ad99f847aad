"""Watching several layer queries: what they did, and what happens when one fails."""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

logger = logging.getLogger(__name__)

Starter = Callable[[], StreamingQuery]


@dataclass
class Seen:
    """What one query has reported since it was watched."""

    batches: int = 0
    rows: int = 0
    #: Rows in streaming state after the last batch.
    state_rows: int = 0
    #: Counts that the query observes on its frames, added up: {name: {column: sum}}.
    observed: dict[str, dict[str, int]] = field(default_factory=dict)
    failures: list[str] = field(default_factory=list)


class LayerMonitor(StreamingQueryListener):
    """Collects the progress of all named queries of a session."""

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._names: dict[str, str] = {}
        self.queries: dict[str, Seen] = {}

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._names[str(event.runId)] = event.name
            self.queries.setdefault(event.name, Seen())

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._lock:
            seen = self.queries.setdefault(progress.name, Seen())
            seen.batches += 1
            seen.rows += max(0, progress.numInputRows)
            seen.state_rows = sum(state.numRowsTotal for state in progress.stateOperators)
            for name, row in (progress.observedMetrics or {}).items():
                counts = seen.observed.setdefault(name, {})
                for column, value in row.asDict().items():
                    counts[column] = counts.get(column, 0) + (value or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            with self._lock:
                name = self._names.get(str(event.runId), str(event.id))
                self.queries.setdefault(name, Seen()).failures.append(event.exception)


class LayerFailed(RuntimeError):
    """A query failed for good; the others were stopped."""


def supervise(
    spark: SparkSession,
    starters: Mapping[str, Starter],
    restarts: int = 0,
    pause: float = 1.0,
    poll: float = 0.2,
) -> dict[str, int]:
    """Run the named queries until all have ended; returns how often each was restarted.

    A query that fails is started again from its checkpoint, up to ``restarts`` times
    in all and after ``pause`` seconds, twice as many each time. When one has no try
    left, all others are stopped and :class:`LayerFailed` names it: layers that ran on
    would fall apart from the one that stands still.
    """
    running: dict[str, StreamingQuery] = {}
    tries = dict.fromkeys(starters, 0)
    waiting: dict[str, float] = {}
    try:
        for name, start in starters.items():
            running[name] = start()
        while running or waiting:
            now = time.monotonic()
            for name in [n for n, at in waiting.items() if at <= now]:
                del waiting[name]
                running[name] = starters[name]()
            for name, query in list(running.items()):
                if query.isActive:
                    continue
                del running[name]
                error = query.exception()
                if error is None:
                    continue
                if tries[name] >= restarts:
                    raise LayerFailed(f"{name} failed after {tries[name]} restarts: {error}") from error
                logger.warning("%s failed and is started again: %s", name, error)
                waiting[name] = now + pause * 2 ** tries[name]
                tries[name] += 1
            if running or waiting:
                time.sleep(poll)
    finally:
        for query in running.values():
            query.stop()
    return tries
