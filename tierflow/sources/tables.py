"""Stored tables, as a batch scan or as a throttled stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tierflow.sinks.commits import CommitLog, Entry, Merged, folders
from tierflow.sinks.tables import FILE_FORMATS


def read_table(
    spark: SparkSession,
    name: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    schema: StructType | None = None,
    only: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """A whole table. Give the schema where a partition column must keep its type:
    a text ``batch_id`` is otherwise read back as a number. A table with a commit log
    is what the log says; ``only`` leaves out other folders of a level by their names."""
    if fmt in FILE_FORMATS:
        log = CommitLog(spark, name)
        entries = log.entries() if log.exists() else []
        if entries:
            return read_entries(spark, name, entries, fmt, options, schema, only)
    reader = spark.read.format(fmt).options(**(options or {}))
    return (reader.schema(schema) if schema else reader).load(name)


def read_entries(
    spark: SparkSession,
    name: str,
    entries: Sequence[Entry],
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    schema: StructType | None = None,
    only: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """The rows of some commits of a table. Merged ones hold the batch as a column; where
    no rows are left, a schema is needed."""

    def load(base: str, paths: list[str]) -> DataFrame:
        reader = spark.read.format(fmt).options(**(options or {})).option("basePath", base)
        return (reader.schema(schema) if schema else reader).load([f"{name}/{path}" for path in paths])

    parts = []
    plain = folders([e for e in entries if not isinstance(e, Merged)], only)
    if plain:
        parts.append(load(name, plain))
    for entry in entries:
        if isinstance(entry, Merged) and (paths := folders([entry], only)):
            parts.append(load(f"{name}/{entry.folder}", paths))
    if not parts:
        if schema is None:
            raise ValueError(f"no rows of {name} are left; give its schema")
        return spark.createDataFrame([], schema)
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows


def stream_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    max_files: int | None = None,
    max_bytes: int | None = None,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """New files of a table that has no commit log, all or at most ``max_files`` or about
    ``max_bytes`` per micro-batch. Tables written in batches are followed by a feed.

    Name the partition columns in folder order: Spark reads them after the others
    and matches a stream's columns by position, so a stream that starts before
    the table has any folder would otherwise mix them up.
    """
    fields = [f for f in schema.fields if f.name not in partition_by]
    fields += [schema[name] for name in partition_by]
    reader = spark.readStream.format(fmt).schema(StructType(fields))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.options(**(options or {})).load(name).select(*schema.fieldNames())
