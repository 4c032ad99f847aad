"""Following a table by its commit log.

A feed hands on the batches of a table in their order, as many at a time as fit into a
number of bytes. How far it got is what the following query's own tables say, not which
files Spark has seen, so a merge of old batches or a new checkpoint repeats nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierflow.sinks.commits import LOG, CommitLog, Entry, Merged
from tierflow.sinks.tables import Target
from tierflow.sources.tables import read_entries

#: The one column of the stream that tells of new commits.
SIGNAL = "value"


@dataclass(frozen=True)
class Group:
    """Batches that are handed on together."""

    entries: tuple[Entry, ...]
    first: int
    last: int


@dataclass(frozen=True)
class Feed:
    """The rows that another query adds to a table. ``transform`` works as on a
    DataFrame, but is applied to each group of batches as it comes."""

    spark: SparkSession
    target: Target
    schema: StructType
    columns: tuple[str, ...]
    key: str = "batch_id"
    steps: tuple[Callable[[DataFrame], DataFrame], ...] = ()

    def transform(self, step: Callable[[DataFrame], DataFrame]) -> Feed:
        return replace(self, steps=(*self.steps, step))

    def log(self) -> CommitLog:
        return CommitLog(self.spark, self.target.name)

    def signals(self) -> DataFrame:
        """A stream with a row per new commit. What it says is read from the log itself."""
        self.log().create()
        return self.spark.readStream.format("text").option("wholetext", True).load(f"{self.target.name}/{LOG}")

    def groups(self, after: int | None, most: int | None = None) -> Iterator[Group]:
        """Batches later than ``after``, grouped up to ``most`` bytes of files; a batch
        that is larger comes alone, whole."""
        return grouped(self.log().entries(after), after, most)

    def rows(self, group: Group) -> DataFrame:
        target = self.target
        rows = read_entries(self.spark, target.name, group.entries, target.fmt, target.options, self.schema)
        if any(isinstance(entry, Merged) for entry in group.entries):
            rows = rows.filter(F.col(self.key).cast("long").between(group.first, group.last))
        rows = rows.select(*self.columns)
        for step in self.steps:
            rows = step(rows)
        return rows


def grouped(entries: Sequence[Entry], after: int | None, most: int | None) -> Iterator[Group]:
    held: list[tuple[Entry, int, int]] = []
    size = 0
    for entry in entries:
        for first, last, part in _parts(entry, after, most):
            if held and most is not None and size + part > most:
                yield _group(held)
                held, size = [], 0
            held.append((entry, first, last))
            size += part
    if held:
        yield _group(held)


def _parts(entry: Entry, after: int | None, most: int | None) -> Iterator[tuple[int, int, int]]:
    """Batches of an entry and their bytes: a merge is split evenly by batch numbers."""
    if not isinstance(entry, Merged):
        if after is None or entry.batch > after:
            yield entry.batch, entry.batch, entry.size
        return
    batches = entry.last - entry.first + 1
    step = batches if most is None else max(1, batches * most // max(1, entry.size))
    for first in range(entry.first, entry.last + 1, step):
        last = min(first + step - 1, entry.last)
        if after is None or last > after:
            begin = first if after is None else max(first, after + 1)
            yield begin, last, entry.size * (last - begin + 1) // batches


def _group(held: list[tuple[Entry, int, int]]) -> Group:
    entries: list[Entry] = []
    for entry, _, _ in held:
        if not entries or entries[-1] is not entry:
            entries.append(entry)
    return Group(tuple(entries), held[0][1], held[-1][2])
