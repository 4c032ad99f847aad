"""Table writers."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql.types import StructType

from tierflow.sinks.commits import Commit, CommitLog, Files, Merged, TableInUse, current_writer, settled

#: Formats whose partitions Spark itself can replace.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro")


@dataclass(frozen=True)
class Target:
    """Where a table lives. ``name`` is a path for file formats, else the name
    handed to the connector as its ``table`` option."""

    name: str
    fmt: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    #: Regroup rows by partition before writing, so that a large load does not
    #: leave one file per task and partition. Adaptive execution splits a
    #: partition that holds most of the rows over several tasks.
    rebalance: bool = False
    #: Name of a folder level above the batches, such as the day of the load.
    stamp: str | None = None
    #: Whether batches are recorded in a commit log. Folders that stand for a topic
    #: are not: anyone may add messages there.
    logged: bool = True

    @property
    def is_files(self) -> bool:
        return self.fmt in FILE_FORMATS

    @property
    def has_log(self) -> bool:
        return self.is_files and self.logged


def _writer(
    df: DataFrame, target: Target, mode: str, partition_by: tuple[str, ...]
) -> DataFrameWriter:
    if target.rebalance and partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(target.fmt).mode(mode).options(**target.options)
    return writer.partitionBy(*partition_by) if partition_by and target.is_files else writer


def _save(writer: DataFrameWriter, target: Target) -> None:
    if target.is_files:
        writer.save(target.name)
    else:
        writer.option("table", target.name).save()


def save_rows(rows: DataFrame, target: Target, path: str, partition_by: tuple[str, ...]) -> None:
    """Write rows to a folder of a file table."""
    _writer(rows, target, "overwrite", partition_by).save(path)


def append_table(df: DataFrame, target: Target) -> None:
    """Add rows that are no batch. Readers of a commit log would not find them."""
    if target.has_log and CommitLog(df.sparkSession, target.name).exists():
        raise TableInUse(f"{target.name} is written in batches; use write_batch")
    _save(_writer(df, target, "append", target.partition_by), target)


def replace_table(df: DataFrame, target: Target) -> None:
    _save(_writer(df, target, "overwrite", target.partition_by), target)


def ensure_table(spark: SparkSession, target: Target, schema: StructType) -> None:
    """An empty file table where there is none, so that a stream can follow it."""
    if target.is_files:
        empty = spark.createDataFrame([], schema)
        _save(_writer(empty, target, "ignore", target.partition_by), target)


STAGED = "_staged"


def remove_folder(spark: SparkSession, path: str) -> None:
    Files(spark, path).delete("")


def _batches(target: Target, key: str, batch: int | str) -> str:
    return f"{target.stamp + '=*/' if target.stamp else ''}{key}={batch}"


def is_published(spark: SparkSession, target: Target, batch_id: int, key: str = "batch_id") -> bool:
    """Whether a file table holds this batch already. Connectors cannot tell."""
    if not target.is_files:
        return False
    if target.logged:
        log = opened(spark, target, key)
        return log.get(log.claim(batch_id)) is not None
    return bool(Files(spark, target.name).matching(_batches(target, key, batch_id)))


def opened(spark: SparkSession, target: Target, key: str = "batch_id") -> CommitLog:
    """The log of a table, made where there is none: batches that lie there already,
    from before there were logs, are recorded first."""
    log = CommitLog(spark, target.name)
    if not log.exists():
        found = log.files.matching(_batches(target, key, "*"))
        log.create()
        for folder in found:
            batch = int(folder.rpartition("=")[2])
            log.put(Commit(batch, None, folder, log.files.data_files(folder)))
    return log


def write_batch(
    df: DataFrame,
    target: Target,
    batch_id: int,
    key: str = "batch_id",
    stamp: str | None = None,
    replace: bool = False,
    filled: bool = False,
    note: Callable[[str], Mapping[str, object]] | None = None,
) -> bool:
    """Write one batch so that writing it again changes nothing, here or in whatever
    follows the table. Returns whether rows were written now.

    A file table gets the batch as one folder ``key=<batch>``: the files are written
    aside, the folder is moved into place by one rename, and a commit in the table's log
    makes it part of the table, with the name of the writing query and what ``note`` says
    of the path of the folder. A batch that has its commit is left alone. One whose folder is in place without a commit, as
    after a crash between the two, gets its commit only.

    ``replace`` puts the new rows in the place of the old ones, also if there are none:
    new files are written beside the old, one rename swaps the commit, and then the old
    files go. Readers of the log see all old rows or all new ones at any moment, and what
    a crash leaves behind goes when the batch is written next.

    A query whose checkpoint is not the one that wrote the table is refused or goes on
    after the newest batch, see :meth:`CommitLog.claim`. ``stamp`` is the value of the
    folder level above, if the target has one. A connector has no such handle: it gets an
    append, and an empty batch is not sent. ``filled`` says that the caller knows of rows;
    the test for rows is an action of its own, and an observed frame counts its first
    action only.
    """
    if not target.is_files:
        if not filled and df.isEmpty():
            return False
        append_table(df, target)
        return True
    spark = df.sparkSession
    rows = df.drop(*{key, target.stamp} & set(df.columns))
    below = tuple(c for c in target.partition_by if c != key)
    if not target.logged:
        return _move_in(rows, target, Files(spark, target.name), key, batch_id, stamp, below)[1]
    log = opened(spark, target, key)
    batch, writer = log.claim(batch_id), current_writer()
    before = log.get(batch)
    if isinstance(before, Merged):
        if replace:
            raise TableInUse(f"batch {batch} of {target.name} is merged with others and cannot be replaced")
        return False
    if before is not None and writer and before.writer not in (None, writer.name):
        raise TableInUse(f"batch {batch} of {target.name} was written by {before.writer}, not by {writer.name}")
    who = writer.name if writer else None
    if before is not None and replace:
        _replace_files(rows, target, log, before, f"{key}={batch}", below, Commit(batch, who))
        return True
    if before is not None:
        return False
    folder, wrote = _move_in(rows, target, log.files, key, batch, stamp, below)
    kept = dict(note(f"{target.name}/{folder}")) if note else {}
    log.put(Commit(batch, who, folder, log.files.data_files(folder), note=kept))
    return wrote


def commit_empty(spark: SparkSession, target: Target, batch_id: int, key: str = "batch_id") -> None:
    """Record that a batch has no rows for a table."""
    if target.has_log:
        log, writer = opened(spark, target, key), current_writer()
        batch = log.claim(batch_id)
        if log.get(batch) is None:
            log.put(Commit(batch, writer.name if writer else None))


def _move_in(
    rows: DataFrame, target: Target, files: Files, key: str, batch: int, stamp: str | None, below: tuple[str, ...]
) -> tuple[str, bool]:
    """Write a batch aside and move it in, unless it is there. Returns its folder, and
    whether it was written now."""
    there = files.matching(_batches(target, key, batch))
    if there:
        return there[0], False
    staged = f"{STAGED}/{key}={batch}"
    _writer(rows, target, "overwrite", below).save(f"{target.name}/{staged}")
    folder = f"{target.stamp}={stamp}/{key}={batch}" if target.stamp else f"{key}={batch}"
    files.move(staged, folder)
    return folder, True


def _replace_files(
    rows: DataFrame, target: Target, log: CommitLog, before: Commit, folder: str, below: tuple[str, ...], after: Commit
) -> None:
    folder = before.folder or folder
    # Left over from a try that did not get to its commit, or not past it.
    for name in log.files.data_files(folder).keys() - before.files.keys():
        log.files.delete(f"{folder}/{name}")
    # From here to the end the folder holds more than the table does.
    log.put(dataclasses.replace(before, folder=folder, settled=False))
    _writer(rows, target, "append", below).save(f"{target.name}/{folder}")
    found = log.files.data_files(folder)
    new = {name: size for name, size in found.items() if name not in before.files}
    swapped = dataclasses.replace(after, folder=folder, files=new, settled=False)
    log.put(swapped)
    for name in before.files:
        log.files.delete(f"{folder}/{name}")
    log.put(settled(swapped))
