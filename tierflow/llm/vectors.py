"""Embedding near-duplicates by cross-polytope hashing.

Each hash rotates a vector with random signs and fast Hadamard transforms and takes
the nearest signed axis. A table joins several hashes; each vector also probes the
bucket behind its least certain hash. Pairs that meet in a bucket are verified by
their exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import lists, map_batches, map_groups, stored, usable_vector
from tierflow.llm.components import components

#: Hash tables, hashes joined per table, and rounds of signs and transforms per hash.
TABLES, JOINED, TURNS = 14, 3, 3
#: Members of a bucket that one task compares; larger buckets are cut into blocks.
BLOCK = 512


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    rows, width = x.shape
    step = 1
    while step < width:
        pairs = x.reshape(rows, width // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
        x = x.reshape(rows, width)
        step *= 2
    return x / np.sqrt(width)


def bucket_keys(unit: np.ndarray, tables: int = TABLES, joined: int = JOINED, seed: int = 5) -> np.ndarray:
    """Two keys per table for each row: its own bucket and the probe."""
    rows, size = unit.shape
    width = 1 << max(0, size - 1).bit_length()
    padded = np.zeros((rows, width))
    padded[:, :size] = unit
    draw = np.random.default_rng([seed, width])
    keys = np.zeros((rows, tables, 2), dtype=np.uint64)
    every = np.arange(rows)
    for table in range(tables):
        best, second, gap = (np.zeros((joined, rows), dtype=t) for t in (np.uint64, np.uint64, float))
        for part in range(joined):
            turned = padded
            for _ in range(TURNS):
                turned = hadamard(turned * draw.choice([-1.0, 1.0], width))
            size_of = np.abs(turned)
            first = size_of.argmax(axis=1)
            top = size_of[every, first]
            size_of[every, first] = -1
            other = size_of.argmax(axis=1)
            gap[part] = top - size_of[every, other]
            best[part] = 2 * first + (turned[every, first] < 0)
            second[part] = 2 * other + (turned[every, other] < 0)
        weak = gap.argmin(axis=0)
        probe = best.copy()
        probe[weak, every] = second[weak, every]
        for place, codes in enumerate((best, probe)):
            key = np.full(rows, (table * 1_000_003 + size) & 0xFFFFFFFF, dtype=np.uint64)
            for code in codes:
                key = (key ^ code) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(29)
            keys[:, table, place] = key
    return keys.reshape(rows, -1).view(np.int64)


def _by_length(values: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of equal length as one matrix, with their places."""
    sizes = np.diff(offsets)
    for size in np.unique(sizes):
        places = np.flatnonzero(sizes == size)
        yield places, values[offsets[places][:, None] + np.arange(size)]


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64) / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _hashed(classes: DataFrame) -> DataFrame:
    """(class, n, unit, keys) per distinct vector."""

    def compute(batch: pa.RecordBatch):
        values, offsets = lists(batch.column(2))
        units, keys = [b""] * batch.num_rows, [None] * batch.num_rows
        for places, rows in _by_length(values, offsets):
            unit = _unit(rows)
            for place, row, key in zip(places.tolist(), unit, bucket_keys(unit)):
                units[place], keys[place] = row.tobytes(), key
        columns = [batch.column(0), batch.column(1), pa.array(units, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["class", "n", "unit", "keys"])

    vectors = classes.select("class", "n", F.col("embedding").cast("array<double>"))
    return map_batches(vectors, compute, "class long, n long, unit binary, keys array<long>")


def _links(threshold: float):
    """Per group: links of each member and a spanning forest of them. A pair counts
    only in the smallest key that both members have, so in one group of all."""

    def find(rows: pa.Table, bounds: np.ndarray):
        column = lambda name: rows.column(name).to_numpy()
        key, names, copies = column("key"), column("class"), column("n")
        left, right, own = column("low"), column("high"), column("own")
        units = rows.column("unit").to_pylist()
        values, offsets = lists(rows.column("keys"))
        keys = values.reshape(rows.num_rows, -1) if rows.num_rows else values
        out: list[tuple] = []
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            part = slice(low, high)
            unit = np.frombuffer(b"".join(units[part]), dtype=np.float64).reshape(high - low, -1)
            near = unit @ unit.T >= threshold
            if left[low] == right[low]:
                near &= np.tri(high - low, k=-1, dtype=bool).T
            else:
                near &= (own[part] == left[low])[:, None] & (own[part] == right[low])[None, :]
            a, b = np.nonzero(near)
            if not len(a):
                continue
            good = np.concatenate([_owned(keys[part], a[i : i + 8192], b[i : i + 8192], key[low]) for i in range(0, len(a), 8192)])
            a, b = a[good], b[good]
            if not len(a):
                continue
            links = np.zeros(high - low, dtype=np.int64)
            np.add.at(links, a, copies[part][b])
            np.add.at(links, b, copies[part][a])
            label = _labels(high - low, a, b)
            touched = np.flatnonzero(links)
            out.append((names[part][touched], links[touched], names[part][label[touched]]))
        if out:
            columns = [pa.array(np.concatenate(c), pa.int64()) for c in zip(*out)]
            yield pa.RecordBatch.from_arrays(columns, names=["class", "links", "root"])

    return find


def _owned(keys: np.ndarray, a: np.ndarray, b: np.ndarray, key: int) -> np.ndarray:
    common = (keys[a][:, :, None] == keys[b][:, None, :]).any(axis=2)
    return np.where(common, keys[a], np.iinfo(np.int64).max).min(axis=1) == key


def _labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member that links reach, within one group."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, a, least)
        np.minimum.at(after, b, least)
        after = after[after]
        if (after == label).all():
            return label
        label = after


def near_vectors(embeddings: DataFrame, threshold: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per input row.

    Vectors link from a cosine of ``threshold`` on, in double precision, whatever
    their labels. Equal vectors are compared as one with a count, so copies never
    become pairs; each links with all its other copies. Vectors of different
    lengths do not link. Null, zero and not finite vectors link with nothing and
    form their own component; so do rows with a null id, whose component is null
    and which are not kept. Other columns are not read, an empty table gives no rows.
    """
    valid = usable_vector("embedding") & F.col("vec_id").isNotNull()
    rows = embeddings.select("vec_id", F.when(valid, F.col("embedding")).alias("embedding"))
    rows = rows.withColumn("class", F.when(F.col("embedding").isNotNull(), F.xxhash64("embedding")))
    grouped = rows.filter(F.col("class").isNotNull()).groupBy("class")
    classes = stored(
        grouped.agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("embedding").alias("embedding")),
        "vector-classes",
    )
    hashed = stored(_hashed(classes), "vector-keys")
    members = hashed.select("class", F.explode(F.array_distinct("keys")).alias("key"))
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    sizes = sizes.select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    met = members.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("class"), "blocks").cast("int"))
    # Each block of a bucket meets each other block of it once.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = met.select("key", "class", "own", other).select(
        "key", "class", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    )
    full = dealt.join(hashed, "class").select("key", "low", "high", "own", "class", "n", "unit", "keys")
    found = map_groups(full, ["key", "low", "high"], _links(threshold), "class long, links long, root long")
    found = stored(found, "vector-links")
    grouped = components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    named = classes.select("class", "least", "n").join(grouped.withColumnRenamed("node", "class"), "class", "left")
    named = named.withColumn("component", F.coalesce("component", "class"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    known = named.join(links, "class", "left").join(smallest, "component")
    known = known.select("class", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"))
    result = rows.select("vec_id", "class").join(known, "class", "left")
    component = F.coalesce("component_id", "vec_id")
    return result.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
