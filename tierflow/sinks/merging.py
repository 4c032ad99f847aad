"""Merging old batches of a table, so that neither its files nor its log grow with the
number of batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tierflow.sinks.commits import CommitLog, Entry, Merged
from tierflow.sinks.tables import Target, save_rows
from tierflow.sources.tables import read_entries

#: Entries of one level that become one of the next, and bytes from which an entry is
#: large enough to be left alone.
FAN, LARGE = 8, 256 << 20


def merge_batches(
    spark: SparkSession,
    target: Target,
    schema: StructType,
    keep: int = 0,
    combine: Callable[[DataFrame], DataFrame] | None = None,
    key: str = "batch_id",
    fan: int = FAN,
    large: int = LARGE,
) -> int:
    """Merge runs of ``fan`` entries of one level, oldest first, until there are none;
    returns how many merges that took. The newest ``keep`` batches stay as they are.

    The rows of a run are written together, the batch as a column, and one commit takes
    the place of theirs: readers of the log see the same rows before and after, and
    followers know by batch number what they have. ``combine`` may reduce the rows to
    fewer that mean the same; they belong to no single batch then. Entries of ``large``
    bytes or more stay alone. A row is rewritten about once per level, that is, a number
    of times logarithmic in the number of batches.

    Only for tables whose batches come in the order of their numbers, as those of streams
    do. What was merged stays on disk until the next merge, for readers that have planned
    on it. A crash leaves files that no commit names, or commits that a merge hides.
    """
    log, done = CommitLog(spark, target.name), 0
    _remove_retired(log)
    while run := _next_run(log.entries(), keep, fan, large if combine is None else None):
        _merge(spark, target, schema, log, run, combine, key)
        done += 1
    return done


def _level(entry: Entry) -> int:
    return entry.level if isinstance(entry, Merged) else 0


def _next_run(entries: Sequence[Entry], keep: int, fan: int, large: int | None) -> list[Entry]:
    old = entries[: len(entries) - keep] if keep else entries
    run: list[Entry] = []
    for entry in old:
        if large is not None and entry.size >= large:
            run = []
            continue
        if run and _level(run[0]) != _level(entry):
            run = []
        run.append(entry)
        if len(run) == fan:
            return run
    return []


def _merge(
    spark: SparkSession,
    target: Target,
    schema: StructType,
    log: CommitLog,
    run: Sequence[Entry],
    combine: Callable[[DataFrame], DataFrame] | None,
    key: str,
) -> None:
    first = run[0].first if isinstance(run[0], Merged) else run[0].batch
    last = run[-1]
    retired: list[str] = []
    for entry in run:
        retired += [*(entry.retired if isinstance(entry, Merged) else ()), *([entry.folder] if entry.folder else [])]
    folder = f"merged-{first}-{last.batch}-{uuid4().hex[:8]}"
    rows = read_entries(spark, target.name, run, target.fmt, target.options, schema)
    levels = (*((target.stamp,) if target.stamp else ()), *target.partition_by)
    if combine is not None:
        rows = combine(rows)
    else:
        # In batch order, so that a follower's batches are found by their statistics.
        parts = max(1, sum(entry.size for entry in run) // LARGE + 1)
        rows = rows.repartitionByRange(parts, key).sortWithinPartitions(*levels, key)
    save_rows(rows, target, f"{target.name}/{folder}", levels)
    level = max(map(_level, run)) + 1
    log.put(Merged(first, last.batch, folder, log.files.data_files(folder), level, last.note, tuple(retired)))
    for entry in run:
        log.forget(entry)


def _remove_retired(log: CommitLog) -> None:
    for entry in log.entries():
        if isinstance(entry, Merged) and entry.retired:
            for folder in entry.retired:
                log.files.delete(folder)
            log.put(replace(entry, retired=()))
