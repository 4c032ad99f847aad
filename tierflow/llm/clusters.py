"""Centroid clustering with a vantage-point tree over the centroids.

Every round builds a tree of the centroids anew and ships it to the tasks, where
each vector searches it best first: of the nodes it has not opened it takes the one
whose distance interval comes closest, measures that node's own centroid exactly,
and never opens a node that cannot hold anything as near as its best so far. All
vectors of a batch search side by side, each with its own bounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import find_package, lists, map_batches, stored

#: Greatest size of a component as an integer: squared distances of vectors of up to
#: 64 of these fit in 64 bits.
LARGEST = 1 << 27
#: Share by which bounds are kept on the safe side of rounding.
SLACK = 1e-9
#: Vectors of one search step.
LANES = 4096


@dataclass(frozen=True)
class VantageTree:
    """Nodes in arrays. A node holds one centroid; its inner child holds the nearer half
    of the rest, its outer child the other half, each with the least and the greatest
    distance of its centroids to the node's own."""

    centroids: np.ndarray
    centroid: np.ndarray
    child: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid and the squared distance, exact integers;
        of equally near ones the smallest number."""
        found = [self._search(vectors[at : at + LANES]) for at in range(0, len(vectors), LANES)]
        if not found:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return tuple(np.concatenate(part) for part in zip(*found))

    def _search(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(vectors)
        # What a node cannot be nearer than, per vector; the closed ones are infinite.
        bound = np.full((n, len(self.centroid)), np.inf)
        bound[:, 0] = 0
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, -1, dtype=np.int64)
        reach = np.full(n, np.inf)
        alive = np.arange(n)
        while len(alive):
            node = bound[alive].argmin(axis=1)
            # A bound equal to the best distance stays in: a tie may have a smaller number.
            open_ = bound[alive, node] <= reach[alive]
            alive, node = alive[open_], node[open_]
            if not len(alive):
                break
            parent = bound[alive, node]
            bound[alive, node] = np.inf
            mine = self.centroid[node]
            square = ((vectors[alive] - self.centroids[mine]) ** 2).sum(axis=1)
            nearer = (square < best[alive]) | ((square == best[alive]) & (mine < number[alive]))
            won = alive[nearer]
            best[won], number[won] = square[nearer], mine[nearer]
            distance = np.sqrt(square.astype(np.float64))
            reach[won] = distance[nearer] * (1 + SLACK)
            for side in (0, 1):
                child = self.child[node, side]
                has = child >= 0
                at, to = alive[has], distance[has]
                gap = np.maximum(self.low[node[has], side] - to, to - self.high[node[has], side])
                # Rounding grows with the distances that are subtracted.
                gap -= SLACK * (to + self.high[node[has], side])
                bound[at, child[has]] = np.maximum(parent[has], gap)
        return number, best


def vantage_tree(centroids: np.ndarray) -> VantageTree:
    """A tree over centroids (rows of integers). Equal centroids are fine."""
    k = len(centroids)
    centroid, child = np.zeros(k, dtype=np.int64), np.full((k, 2), -1, dtype=np.int64)
    low, high = np.zeros((k, 2)), np.zeros((k, 2))
    made = 0
    waiting = [(np.arange(k), -1, 0)] if k else []
    while waiting:
        members, parent, side = waiting.pop()
        node, made = made, made + 1
        if parent >= 0:
            child[parent, side] = node
        own, rest = members[0], members[1:]
        centroid[node] = own
        square = ((centroids[rest] - centroids[own]) ** 2).sum(axis=1)
        order = np.lexsort((rest, square))
        rest, distance = rest[order], np.sqrt(square[order].astype(np.float64))
        half = (len(rest) + 1) // 2
        for side, part in enumerate((slice(0, half), slice(half, None))):
            if len(rest[part]):
                low[node, side], high[node, side] = distance[part][0], distance[part][-1]
                waiting.append((rest[part], node, side))
    return VantageTree(centroids, centroid, child, low, high)


def _whole(vector: Column, dimensions: int) -> Column:
    """Whether a vector has that many components, none null, not finite or too large."""
    fits = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * 64) <= F.lit(float(LARGEST))))
    return F.coalesce((F.size(vector) == dimensions) & fits, F.lit(False))


def integer_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = 64
) -> DataFrame:
    """(vec_id, q) of the vectors that take part, each component floor(64 * x)."""
    as_double = F.col(vector_col).cast("array<double>")
    kept = vectors.filter(_whole(as_double, dimensions))
    scaled = F.transform(as_double, lambda x: F.floor(x * F.lit(64.0)).cast("int"))
    return kept.select(F.col(id_col).cast("long").alias("vec_id"), scaled.alias("q"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    values, _ = lists(batch.column("q"))
    return values.astype(np.int64).reshape(batch.num_rows, -1)


def _starts(kept: DataFrame, k: int) -> np.ndarray:
    """The k vectors with the smallest hashes of their ids; rows of one id by their
    components, a null id last."""
    mark = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    rows = kept.select(mark.alias("mark"), "q").orderBy(F.col("mark").asc_nulls_last(), "q").limit(k).collect()
    return np.array([r["q"] for r in rows], dtype=np.int64)


def _sums(kept: DataFrame, tree: VantageTree) -> DataFrame:
    """(cluster, n, sums): per task the number of vectors of each cluster and their sum."""
    find_package(kept.sparkSession)
    k, dimensions = tree.centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dimensions), dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                cluster, _ = tree.nearest(x)
                order = np.argsort(cluster, kind="stable")
                mine, begins = np.unique(cluster[order], return_index=True)
                sums[mine] += np.add.reduceat(x[order], begins, axis=0)
                n += np.bincount(cluster, minlength=k)
        some = np.flatnonzero(n)
        if len(some):
            offsets = pa.array(np.arange(len(some) + 1, dtype=np.int32) * dimensions)
            packed = pa.ListArray.from_arrays(offsets, pa.array(sums[some].ravel()))
            columns = [pa.array(some.astype(np.int32)), pa.array(n[some]), packed]
            yield pa.RecordBatch.from_arrays(columns, names=["cluster", "n", "sums"])

    return kept.mapInArrow(run, "cluster int, n long, sums array<long>")


def _moved(kept: DataFrame, tree: VantageTree) -> np.ndarray:
    """The centroids after one round: the floored means of their vectors, added up
    exactly; empty ones stay. One row per cluster reaches the driver."""
    k, dimensions = tree.centroids.shape
    totals = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).cast("string").alias(f"s{i}") for i in range(dimensions)]
    after = tree.centroids.copy()
    for row in _sums(kept, tree).groupBy("cluster").agg(F.sum("n").alias("n"), *totals).collect():
        after[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(dimensions)]
    return after


def _assigned(kept: DataFrame, tree: VantageTree) -> DataFrame:
    def assign(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        cluster, distance = tree.nearest(_matrix(batch))
        columns = [batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)]
        yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    return map_batches(kept, assign, "vec_id long, cluster int, distance long")


def cluster_vectors(
    vectors: DataFrame,
    k: int = 16,
    rounds: int = 3,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dimensions: int = 64,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of each vector that takes part, and the centroids.

    Vectors take part if they have ``dimensions`` components, none null or not finite;
    one with a component of more than two million (2^27 / 64) takes none either, as its
    squared distances would not fit in 64 bits. Components become floor(64 * x). The
    first centroids are the ``k`` vectors with the smallest SHA-256 of ``1:<vec_id>``
    (fewer, if there are fewer); each of ``rounds`` assigns every vector to the nearest
    and moves the centroids to the floored means; then vectors are assigned once more.
    Distances are squared and exact, of equally near centroids the smallest number
    counts, empty centroids stay. Repeated rows count each. A null id is hashed last.
    Other columns are not read. No vectors give no rows and no centroids.

    What is shipped to every task is the tree, ``k`` times ``dimensions`` integers.
    """
    kept = stored(integer_vectors(vectors, id_col, vector_col, dimensions), "cluster-vectors")
    centroids = _starts(kept, k).reshape(-1, dimensions)
    if not len(centroids):
        return kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    for _ in range(rounds):
        centroids = _moved(kept, vantage_tree(centroids))
    return _assigned(kept, vantage_tree(centroids)), centroids


def cluster_report(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds cluster_inertia, inertia and centroid_sha256 to the rows of
    :func:`cluster_vectors`. Sums that pass 64 bits are null."""
    done = stored(assigned, "cluster-assigned")
    part = F.sum(F.col("distance").cast("decimal(38,0)")).cast("string")
    # One row per cluster, here and in the table that goes to every task.
    inertia = {r["cluster"]: int(r["part"]) for r in done.groupBy("cluster").agg(part.alias("part")).collect()}
    rows = [
        (number, _long(inertia[number]), _long(sum(inertia.values())), ",".join(map(str, row)))
        for number, row in enumerate(centroids.tolist())
        if number in inertia
    ]
    schema = "cluster int, cluster_inertia long, inertia long, components string"
    per = assigned.sparkSession.createDataFrame(rows, schema)
    return done.join(F.broadcast(per), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2("components", 256).alias("centroid_sha256")
    )


def _long(value: int) -> int | None:
    return value if value < 1 << 63 else None
