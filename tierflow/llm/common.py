"""What the operators share: tables, stored intermediate results, Arrow mapping."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.session import work_dir

#: Rows of one Arrow batch: whole documents, so a batch stays a few megabytes.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold whole documents without growing large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage, so that what follows survives a lost executor without
    computing everything again, and gives the planner true sizes.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a stored table that nothing reads any more."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def find_package(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver
    has it, whatever folder the driver was started in. Clusters install it."""
    root = str(Path(__file__).resolve().parents[2])
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str
) -> DataFrame:
    """Apply ``fn`` to each Arrow batch inside the tasks."""
    find_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return df.mapInArrow(run, schema)


def map_groups(
    df: DataFrame,
    keys: list[str],
    fn: Callable[[pa.Table, np.ndarray], Iterable[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """Apply ``fn`` to runs of whole groups: a table sorted by ``keys`` and the places
    where its groups begin and end. Unlike grouped UDFs it costs one call for many
    small groups. Keys are never null; the caller bounds the size of a group."""
    find_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Batches of one unfinished group, joined only once it ends.
        held: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            if held:
                ends = pa.concat_tables([held[-1].slice(held[-1].num_rows - 1), rows.slice(0, 1), rows.slice(batch.num_rows - 1)])
                if not len(_changes(ends, keys)):
                    held.append(rows)
                    continue
            rows = pa.concat_tables([*held, rows]).combine_chunks()
            bounds = _changes(rows, keys)
            if len(bounds):
                yield from fn(rows.slice(0, bounds[-1]), np.concatenate([[0], bounds]))
            held = [rows.slice(bounds[-1] if len(bounds) else 0)]
        if held:
            last = pa.concat_tables(held).combine_chunks()
            yield from fn(last, np.array([0, last.num_rows]))

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def _changes(rows: pa.Table, keys: list[str]) -> np.ndarray:
    """Places where the key differs from the row before."""
    changed = np.zeros(max(0, rows.num_rows - 1), dtype=bool)
    for key in keys:
        column = rows.column(key).combine_chunks()
        differs = pc.not_equal(column.slice(1), column.slice(0, rows.num_rows - 1))
        changed |= differs.to_numpy(zero_copy_only=False)
    return np.flatnonzero(changed) + 1


def lists(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column, whatever slice of a larger one it is."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = array.offsets.to_numpy()
    return array.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], offsets - offsets[0]


def usable_vector(name: str) -> Column:
    """Whether a vector has components, none null or infinite, and is not zero."""
    vector = F.col(name).cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))
