"""Approximate nearest neighbours by inner product: NN-descent and greedy graph search.

NN-descent starts from lists found among vectors on the same side of some random
planes and improves them through joins of neighbours of neighbours: whoever shares
a neighbour is compared. Queries then walk the graph, always expanding the best
vectors found so far, until those have all been expanded.

A further component makes all vectors equally long, so that the largest inner
product is the smallest distance and lists can be built between any two of them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.common import discard, lists, map_batches, map_groups, stored, usable_vector

#: Neighbours kept per vector, and vectors that have it as neighbour.
DEGREE = 24
#: Random plane partitions that give the first lists, and vectors per part.
STARTS, PART = 3, 192
#: Descent ends when fewer than this share of the list entries are new.
CHANGED = 0.05
#: Best vectors that a search keeps and expands among ``FEW`` vectors, and how many it
#: expands at once. The beam grows with the square root of the number of vectors.
BEAM, FEW, STEP = 320, 50_000, 96
#: Partners proposed to each member of a neighbourhood per round.
PROPOSED = 6


def _packed(rows: np.ndarray) -> list[bytes]:
    """A vector's own factor, its further component, and the others as bytes. Scaled by
    its own largest component, a short vector keeps its bits beside a long one."""
    own = rows[:, :-1]
    factor = np.abs(own).max(axis=1, keepdims=True) / 127
    small = np.rint(own / factor).clip(-127, 127).astype(np.int8)
    ends = np.concatenate([factor, rows[:, -1:]], axis=1).astype("<f4")
    return [r.tobytes() for r in np.concatenate([ends.view(np.int8), small], axis=1)]


def _split(cells: bytes, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Of ``count`` packed vectors (factor, further component) and the other ones."""
    data = np.frombuffer(cells, dtype=np.int8).reshape(count, -1)
    return np.ascontiguousarray(data[:, :8]).view("<f4"), data[:, 8:].astype(np.float32)


def _unpacked(column) -> np.ndarray:
    cells = column.to_pylist()
    ends, own = _split(b"".join(cells), len(cells))
    return np.concatenate([own * ends[:, :1], ends[:, 1:]], axis=1)


def _vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vector), one row per id: repeated rows are one vector, and of several
    vectors with one id the smallest counts."""
    fine = embeddings.filter(usable_vector("embedding") & F.col("vec_id").isNotNull())
    plain = fine.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    return stored(plain.groupBy("vec_id").agg(F.min("vector").alias("vector")), "nn-ids")


def _nodes(plain: DataFrame, members: int) -> tuple[DataFrame, int]:
    """(node, ids, vector) of equal length and norm, and the width.

    One row per distinct vector, named by its smallest id and with its ``members``
    smallest ids, which is as many as an answer can need. Tasks cut the copies of a
    vector to these before the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    some = plain.withColumn("rank", rank).filter(F.col("rank") <= members)
    plain = some.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    plain = plain.select(F.col("ids")[0].alias("node"), "ids", "vector", square.alias("square"))
    plain = stored(plain, "nn-vectors")
    bound = plain.agg(F.max("square").alias("square"), F.max(F.size("vector")).alias("width")).first()
    if bound["width"] is None:
        return plain.select("node", "ids", "vector"), 0
    most, width = float(bound["square"]), int(bound["width"])
    padding = F.array_repeat(F.lit(0.0), F.lit(width) - F.size("vector"))
    rest = F.sqrt(F.greatest(F.lit(0.0), F.lit(most) - F.col("square")))
    full = F.concat(F.col("vector"), padding, F.array(rest))
    return plain.select("node", "ids", full.alias("vector"), F.col("vector").alias("plain")), width


def _starts(nodes: DataFrame, width: int, count: int) -> DataFrame:
    """(node, ids, scores, fresh): best partners among vectors in the same part."""
    bits = max(0, math.ceil(math.log2(max(1, count / PART))))
    planes = np.random.default_rng(3).normal(size=(STARTS, bits, width + 1))

    def sides(batch: pa.RecordBatch):
        values, offsets = lists(batch.column(1))
        rows = values.reshape(batch.num_rows, -1)
        parts = [[int(c) for c in ((rows @ p.T > 0) @ (1 << np.arange(bits))).tolist()] for p in planes]
        keys = [[part[i] * STARTS + n for n, part in enumerate(parts)] for i in range(batch.num_rows)]
        columns = [batch.column(0), pa.array(_packed(rows), pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["node", "packed", "parts"])

    dealt = map_batches(nodes, sides, "node long, packed binary, parts array<long>")
    dealt = dealt.select("node", "packed", F.explode("parts").alias("part"))
    # Parts that came out large are cut again, so that none outgrows its task.
    sizes = dealt.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / (4 * PART)).cast("int").alias("cuts"))
    dealt = dealt.join(sizes, "part").withColumn("cut", F.pmod(F.xxhash64("node"), "cuts"))

    def best(rows: pa.Table, bounds: np.ndarray):
        nodes_, vectors = rows.column("node").to_numpy(), _unpacked(rows.column("packed"))
        out: list[list] = [[], [], []]
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            ids, part = nodes_[low:high], vectors[low:high]
            score = part @ part.T
            np.fill_diagonal(score, -np.inf)
            keep = min(DEGREE, len(ids) - 1)
            order = np.argsort(-score, axis=1)[:, :keep]
            out[0] += ids.tolist()
            out[1] += ids[order].tolist()
            out[2] += np.take_along_axis(score, order, axis=1).tolist()
        yield _proposals(out)

    found = map_groups(dealt.select("part", "cut", "node", "packed"), ["part", "cut"], best, PROPOSAL)

    def pack(batch: pa.RecordBatch):
        values, _ = lists(batch.column(1))
        none = [[] for _ in range(batch.num_rows)]
        cells = _packed(values.reshape(batch.num_rows, -1))
        yield _proposals([batch.column(0).to_pylist(), none, none], cells)

    return _merged(found.unionByName(map_batches(nodes, pack, PROPOSAL)))


#: Proposals carry no vector; the one former list of each node does.
PROPOSAL = "node long, ids array<long>, scores array<float>, packed binary"
LISTS = "node long, ids array<long>, scores array<float>, news array<boolean>, packed binary"


def _proposals(out: list[list], packed: list[bytes] | None = None) -> pa.RecordBatch:
    columns = [
        pa.array(out[0], pa.int64()), pa.array(out[1], pa.list_(pa.int64())),
        pa.array(out[2], pa.list_(pa.float32())), pa.array(packed or [None] * len(out[0]), pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["node", "ids", "scores", "packed"])


def _merged(proposals: DataFrame) -> DataFrame:
    """Proposals and former lists to the best ``DEGREE`` of each node. A neighbour
    that was in the former list is not new."""

    def merge(rows: pa.Table, bounds: np.ndarray):
        ids, starts = lists(rows.column("ids"))
        scores, _ = lists(rows.column("scores"))
        node = rows.column("node").to_numpy()
        packed = rows.column("packed").combine_chunks()
        former = packed.is_valid().to_numpy(zero_copy_only=False)
        fresh = np.repeat(~former, np.diff(starts))
        row = np.repeat(np.arange(len(bounds) - 1), np.diff(starts[bounds]))
        # One entry per node and neighbour, the old one first.
        order = np.lexsort((fresh, ids, row))
        row, ids, scores, fresh = row[order], ids[order], scores[order], fresh[order]
        first = np.ones(len(row), dtype=bool)
        first[1:] = (row[1:] != row[:-1]) | (ids[1:] != ids[:-1])
        row, ids, scores, fresh = row[first], ids[first], scores[first], fresh[first]
        order = np.lexsort((ids, -scores, row))
        row, ids, scores, fresh = row[order], ids[order], scores[order], fresh[order]
        begin = np.searchsorted(row, np.arange(len(bounds)))
        keep = np.arange(len(row)) - begin[row] < DEGREE
        row, ids, scores, fresh = row[keep], ids[keep], scores[keep], fresh[keep]
        cuts = pa.array(np.searchsorted(row, np.arange(len(bounds))), pa.int32())
        arrays = [pa.ListArray.from_arrays(cuts, pa.array(v, t)) for v, t in ((ids, pa.int64()), (scores, pa.float32()), (fresh, pa.bool_()))]
        cells = packed.take(pa.array(np.flatnonzero(former)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(node[bounds[:-1]]), *arrays, cells], names=["node", "ids", "scores", "news", "packed"]
        )

    return map_groups(proposals, ["node"], merge, LISTS)


def _neighbourhoods(graph: DataFrame) -> DataFrame:
    """(node, other, new, worst, packed): the neighbours of each node and up to
    ``DEGREE`` of the nodes that have it as neighbour, new ones first. One that is
    both comes twice."""
    worst = F.when(F.size("ids") >= DEGREE, F.element_at("scores", -1)).otherwise(F.lit(-1e30)).cast("float")
    vectors = graph.select("node", worst.alias("worst"), "packed")
    edge = F.explode(F.arrays_zip("ids", "news")).alias("edge")
    ahead = graph.select("node", edge).select("node", F.col("edge.ids").alias("other"), F.col("edge.news").alias("new"))
    ahead = ahead.join(vectors.withColumnRenamed("node", "other"), "other")
    # A node brings its own vector along to those it has as neighbours.
    behind = graph.select("node", worst.alias("worst"), "packed", edge)
    behind = behind.select(
        F.col("edge.ids").alias("node"), F.col("node").alias("other"), F.col("edge.news").alias("new"), "worst", "packed"
    )
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.col("new").desc(), F.xxhash64("node", "other")))
    behind = behind.withColumn("rank", rank).filter(F.col("rank") <= DEGREE).drop("rank")
    return ahead.unionByName(behind)


def _members(other: np.ndarray, new: np.ndarray, low: int, high: int) -> np.ndarray:
    """Rows of a neighbourhood with each member once, as new if it is so in either."""
    order = low + np.lexsort((~new[low:high], other[low:high]))
    return order[np.concatenate([[True], other[order[1:]] != other[order[:-1]]])]


def _descended(graph: DataFrame) -> DataFrame:
    """One round: the members of each neighbourhood are compared with each other."""

    def compare(rows: pa.Table, bounds: np.ndarray):
        other, new = rows.column("other").to_numpy(), rows.column("new").to_numpy(zero_copy_only=False)
        worst, vectors = rows.column("worst").to_numpy(), _unpacked(rows.column("packed"))
        out: list[list] = [[], [], []]
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            part = _members(other, new, low, high)
            score = vectors[part] @ vectors[part].T
            ids, news = other[part], new[part]
            score[~(news[:, None] | news[None, :]) | (score <= worst[part][:, None])] = -np.inf
            np.fill_diagonal(score, -np.inf)
            keep = min(PROPOSED, len(part))
            order = np.argpartition(-score, keep - 1, axis=1)[:, :keep]
            top = np.take_along_axis(score, order, axis=1)
            good = np.isfinite(top)
            for place in np.flatnonzero(good.any(axis=1)).tolist():
                mine = good[place]
                out[0].append(int(ids[place]))
                out[1].append(ids[order[place][mine]].tolist())
                out[2].append(top[place][mine].tolist())
        yield _proposals(out)

    found = map_groups(_neighbourhoods(graph), ["node"], compare, PROPOSAL)
    return _merged(found.unionByName(graph.select("node", "ids", "scores", "packed")))


def neighbour_graph(nodes: DataFrame, width: int, count: int) -> DataFrame:
    """The lists of all nodes, with their packed vectors."""
    graph = stored(_starts(nodes, width, count), "nn-graph")
    # Lists only get better, so that it comes to an end.
    while True:
        better = stored(_descended(graph), "nn-graph")
        discard(graph)
        graph = better
        news = graph.agg(F.sum(F.size(F.filter("news", lambda x: x)))).first()[0] or 0
        if news < CHANGED * DEGREE * count:
            break
    return graph


def nearest(
    embeddings: DataFrame, every: int = 20, k: int = 20, beam: int | None = None
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each row whose id is
    divisible by ``every``, among all other rows, by largest inner product.

    Scores are exact, in double precision on the original vectors; ties go to the
    smaller id. Fewer candidates give fewer rows. Rows with a null id and vectors
    that are null, empty, zero or not finite take no part. Repeated rows are one
    vector; of several vectors with one id the smallest counts. Equal vectors are one
    node of the graph, searched once and expanded to their smallest ids in the end.
    Shorter vectors are taken as padded with zeros. Other columns are not read; an
    empty table gives no rows.
    """
    plain = _vectors(embeddings)
    found, width = _nodes(plain, k + 1)
    if not width:
        none = found.select(F.col("node").alias("query_id")).limit(0)
        return none.select(
            "query_id", F.lit(0).alias("rank"), F.col("query_id").alias("vec_id"), F.lit(0.0).alias("score")
        )
    count = found.count()
    if beam is None:
        beam = math.ceil(BEAM * math.sqrt(max(1.0, count / FEW)))
    asked = plain.filter(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "query_id")
    asked = stored(asked.join(found.select("node", F.col("plain").alias("vector")), "vector").select("query_id", "node"), "nn-queries")
    starts = asked.select("node").distinct()
    nodes = found.select("node", "vector")
    if count > 1:
        graph = neighbour_graph(nodes, width, count)
        pools = _search(nodes.join(starts, "node", "left_semi"), graph, beam)
    else:
        pools = starts.select(F.col("node").alias("query"), F.array().cast("array<long>").alias("ids"))
    # The best of the pool by packed vectors, then exactly. Copies of the query count.
    near = F.concat(F.array("query"), F.slice("ids", 1, 4 * k))
    some = pools.select("query", F.explode(near).alias("node"))
    exact = found.select("node", "ids", F.slice("vector", 1, width).alias("vector"))
    own = exact.select(F.col("node").alias("query"), F.col("vector").alias("wanted"))
    pairs = some.join(exact, "node").join(own, "query")
    product = F.aggregate(F.zip_with("wanted", "vector", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    scored = pairs.select("query", "node", "ids", product.alias("score"))
    # No answer needs more than the k + 1 best vectors, nor more than the k + 1 best ids
    # of these: k and the query's own.
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "node"))
    scored = scored.withColumn("rank", rank).filter(F.col("rank") <= k + 1)
    entries = F.transform("ids", lambda i: F.struct((-F.col("score")).alias("less"), i.alias("vec_id"), F.col("score").alias("score")))
    best = scored.groupBy("query").agg(F.slice(F.array_sort(F.flatten(F.collect_list(entries))), 1, k + 1).alias("best"))
    answers = asked.join(best.withColumnRenamed("query", "node"), "node")
    others = F.slice(F.filter("best", lambda e: e["vec_id"] != F.col("query_id")), 1, k)
    answers = answers.select("query_id", F.posexplode(others).alias("place", "e"))
    return answers.select("query_id", (F.col("place") + 1).alias("rank"), F.col("e.vec_id").alias("vec_id"), F.col("e.score").alias("score"))


POOL = "query long, wanted binary, ids array<long>, scores array<float>, done array<boolean>"


def _search(queries: DataFrame, graph: DataFrame, beam: int) -> DataFrame:
    """The ``beam`` best vectors found per query, best first. ``queries`` are nodes."""
    near = _neighbourhoods(graph).select("node", "other", "packed")

    def gather(rows: pa.Table, bounds: np.ndarray):
        other, cells = rows.column("other").to_numpy(), rows.column("packed").to_pylist()
        node, plain = rows.column("node").to_numpy(), np.zeros(rows.num_rows, dtype=bool)
        parts = [_members(other, plain, a, b) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        cuts = np.cumsum([0, *map(len, parts)])
        ids = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(other[np.concatenate(parts)], pa.int64()))
        joined = [b"".join([cells[i] for i in part.tolist()]) for part in parts]
        yield pa.RecordBatch.from_arrays([pa.array(node[bounds[:-1]]), ids, pa.array(joined, pa.binary())], names=["node", "others", "cells"])

    around = map_groups(near, ["node"], gather, "node long, others array<long>, cells binary")
    # Dealt by node once for all rounds; lost parts are read again from the files.
    dealt = stored(around, "nn-around").repartition(_partitions(graph), "node")
    around = dealt.persist(StorageLevel.DISK_ONLY)

    def begin(batch: pa.RecordBatch):
        # A query's further component is zero, so that scores are plain products.
        values, _ = lists(batch.column(1))
        rows = values.reshape(batch.num_rows, -1).astype(np.float32)
        rows[:, -1] = 0
        n = batch.num_rows
        columns = [
            batch.column(0), pa.array([r.tobytes() for r in rows], pa.binary()),
            pa.array([[q] for q in batch.column(0).to_pylist()], pa.list_(pa.int64())),
            pa.array([[-1e30]] * n, pa.list_(pa.float32())), pa.array([[False]] * n, pa.list_(pa.bool_())),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["query", "wanted", "ids", "scores", "done"])

    # A query is a node of the graph, so its walk begins at itself.
    pools = stored(map_batches(queries, begin, POOL), "nn-pools")
    # Pools only get better and nothing is expanded twice while it is in one.
    while True:
        walked = stored(_walk(pools, around, beam), "nn-pools")
        discard(pools)
        pools = walked
        if not pools.filter(F.exists("done", lambda x: ~x)).limit(1).count():
            break
    around.unpersist()
    return pools.select("query", F.filter("ids", lambda i: i != F.col("query")).alias("ids"))


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _walk(pools: DataFrame, around: DataFrame, beam: int) -> DataFrame:
    """Expand the best ``STEP`` vectors of each pool that were not expanded yet."""
    entry = F.arrays_zip("ids", "scores", "done")
    open_ = F.slice(F.filter(entry, lambda e: ~e["done"]), 1, STEP)
    worst = F.when(F.size("ids") >= beam, F.element_at("scores", -1)).otherwise(F.lit(-1e30)).cast("float")
    front = pools.select("query", "wanted", worst.alias("worst"), F.explode(open_).alias("e"))
    front = front.select("query", "wanted", "worst", F.col("e.ids").alias("node"))

    def score(batch: pa.RecordBatch):
        rows = pa.Table.from_batches([batch])
        others, starts = lists(rows.column("others"))
        worst_ = rows.column("worst").to_numpy()
        wanted, cells = rows.column("wanted").to_pylist(), rows.column("cells").to_pylist()
        out: list[list] = [[], []]
        for place, (query, cell) in enumerate(zip(wanted, cells)):
            query = np.frombuffer(query, dtype=np.float32)
            ends, near = _split(cell, len(cell) // (len(query) + 7))
            found = near @ query[:-1] * ends[:, 0]
            good = found > worst_[place]
            out[0].append(others[starts[place] : starts[place + 1]][good].tolist())
            out[1].append(found[good].tolist())
        columns = [rows.column("query").combine_chunks(), pa.array(out[0], pa.list_(pa.int64())), pa.array(out[1], pa.list_(pa.float32()))]
        yield pa.RecordBatch.from_arrays(columns, names=["query", "ids", "scores"])

    found = map_batches(
        front.join(around, "node").select("query", "wanted", "worst", "others", "cells"),
        score,
        "query long, ids array<long>, scores array<float>",
    )
    none = F.array().cast("array<boolean>")
    both = pools.unionByName(
        found.select("query", F.lit(None).cast("binary").alias("wanted"), "ids", "scores", none.alias("done"))
    )

    def merge(rows: pa.Table, bounds: np.ndarray):
        ids, starts = lists(rows.column("ids"))
        scores, _ = lists(rows.column("scores"))
        done, cuts = lists(rows.column("done"))
        wanted, query = rows.column("wanted").to_pylist(), rows.column("query").to_numpy()
        out: list[list] = [[], [], [], [], []]
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            pool = next(i for i in range(low, high) if wanted[i] is not None)
            own = slice(starts[pool], starts[pool + 1])
            flags = done[cuts[pool] : cuts[pool + 1]].astype(bool).copy()
            flags[np.flatnonzero(~flags)[:STEP]] = True
            rest = np.r_[starts[low] : starts[pool], starts[pool + 1] : starts[high]]
            all_ids = np.concatenate([ids[own], ids[rest]])
            all_scores = np.concatenate([scores[own], scores[rest]])
            all_done = np.concatenate([flags, np.zeros(len(rest), dtype=bool)])
            # The pool's entries come first, so they win over repeats.
            first = np.unique(all_ids, return_index=True)[1]
            first = first[np.lexsort((all_ids[first], -all_scores[first]))][:beam]
            out[0].append(int(query[low]))
            out[1].append(wanted[pool])
            out[2].append(all_ids[first].tolist())
            out[3].append(all_scores[first].tolist())
            out[4].append(all_done[first].tolist())
        types = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.float32()), pa.list_(pa.bool_()))
        yield pa.RecordBatch.from_arrays([*map(pa.array, out, types)], names=["query", "wanted", "ids", "scores", "done"])

    return map_groups(both, ["query"], merge, POOL)
