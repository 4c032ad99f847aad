"""Suffix-array removal of repeated byte strings.

A byte goes if a string of ``length`` bytes that covers it also starts elsewhere.
Sorting all suffixes would settle that: a string repeats exactly if its suffix and a
neighbour in the order share ``length`` bytes. Most suffixes need no sorting:

* every string of ``length`` bytes names one of its blocks, the one with the smallest
  hash (an anchor), so equal strings name equal blocks at equal places. Strings with
  an anchor that occurs once cannot repeat;
* strings with the same anchor lie side by side in one context. Equal contexts are
  one, with a count;
* of contexts that differ one suffix is sorted, from the anchor on. What neighbours in
  that order share to the right, and what contexts share to the left of the anchor,
  tells which of their strings repeat.

The sort is a distributed merge sort. Tasks sort runs, front-code them (each suffix
as the length it shares with the one before and the rest) and exchange them by range;
each range merges its runs with a loser tree that compares only bytes behind prefixes
already known to be common.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import discard, map_batches, map_groups, stored

LENGTH = 200
#: Bytes of a block that can be an anchor, or half the length if that is less.
ANCHOR = 32
#: Contexts around one anchor whose left sides a task joins. Around a more common
#: anchor every string is sorted.
TOGETHER = 32_768
#: Suffixes of one sorted run, and the expected size of the sample that sets the ranges.
RUN, SAMPLE = 100_000, 4000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        n = max(n, 1 << 17)
        for place, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[place] = np.multiply.accumulate(steps)
    return _POWERS


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def anchors(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(anchor hash, context hash, low, high, at): strings that start from ``low`` to
    ``high`` have the anchor at ``at``. The rightmost of equal blocks is taken."""
    n, block = len(data), min(ANCHOR, (length + 1) // 2)
    if n < length:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(5))
    power, inverse = _powers(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((np.frombuffer(data, dtype=np.uint8).astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])

    def digest(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (sums[high] - sums[low]) * inverse[low]

    places = np.arange(n - block + 1)
    value = _mixed(digest(places, places + block))
    # The place of the least value in each window, by doubling.
    width, span = length - block + 1, 1
    least = places.astype(np.int64)
    while span < width:
        step = min(span, width - span)
        left, right = least[: len(least) - step], least[step:]
        least = np.where(value[right] <= value[left], right, left)
        span += step
    low = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    high = np.append(low[1:], len(least)) - 1
    at = least[low]
    shape = ((at - low) * 1_000_003 + (high - low)).astype(np.uint64)
    context = _mixed(digest(low, high + length) ^ _mixed(shape))
    return value[at].view(np.int64), context.view(np.int64), low, high, at


def common(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, the first ``known`` bytes being equal."""
    end = min(len(a), len(b))
    if a[known:end] == b[known:end]:
        return end
    step = 8
    while a[known : known + step] == b[known : known + step]:
        known += step
        step *= 2
    while step > 1:
        step >>= 1
        if a[known : known + step] == b[known : known + step]:
            known += step
    return known


def repeated_starts(
    lefts: list[bytes], ahead: list[int], length: int
) -> list[list[tuple[int, int]]]:
    """For each context of one anchor the ranges of distances before the anchor at
    which a string of ``length`` bytes starts that another context has as well.

    Contexts come sorted by the bytes from the anchor on; ``lefts`` are the bytes before
    it, ``ahead`` how many bytes from it on each shares with the one before. They are joined from the longest common ending of their
    left sides to the shortest, the smaller set into the larger; within a set only
    neighbours in the order can share most, so each insertion updates three contexts.
    """
    count = len(lefts)
    # Least values over spans of 1, 2, 4, ... neighbours.
    least = [ahead]
    while 2 << len(least) - 1 <= count:
        half, last = 1 << len(least) - 1, least[-1]
        least.append([min(x, y) for x, y in zip(last, last[half:])])

    def both(low: int, high: int) -> int:
        level = (high - low).bit_length() - 1
        row = least[level]
        return min(row[low + 1], row[high + 1 - (1 << level)])

    turned = sorted(range(count), key=lambda i: lefts[i][::-1])
    backs = [lefts[i][::-1] for i in turned]
    joins = sorted(((common(a, b), n) for n, (a, b) in enumerate(zip(backs, backs[1:]))), reverse=True)
    root = list(range(count))
    held: list[list[int]] = [[i] for i in turned]
    # (distance, shared from the anchor on), the first falling, the second rising.
    steps: list[list[tuple[int, int]]] = [[] for _ in range(count)]

    def find(n: int) -> int:
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    def improve(at: int, back: int, shared: int) -> None:
        known = steps[at]
        if known and known[-1][1] >= shared:
            return
        if known and known[-1][0] == back:
            known.pop()
        known.append((back, shared))

    for back, n in joins:
        large, small = find(n), find(n + 1)
        if len(held[large]) < len(held[small]):
            large, small = small, large
        into = held[large]
        for at in held[small]:
            where = bisect_left(into, at)
            if where:
                shared = both(into[where - 1], at)
                improve(at, back, shared)
                improve(into[where - 1], back, shared)
            if where < len(into):
                shared = both(at, into[where])
                improve(at, back, shared)
                improve(into[where], back, shared)
            into.insert(where, at)
        held[small] = []
        root[small] = large
    found: list[list[tuple[int, int]]] = []
    for known in steps:
        ranges: list[tuple[int, int]] = []
        for (back, shared), (below, _) in zip(known, [*known[1:], (-1, 0)]):
            low = max(below + 1, length - shared)
            if low > back:
                continue
            if ranges and ranges[-1][0] == back + 1:
                ranges[-1] = (low, ranges[-1][1])
            else:
                ranges.append((low, back))
        found.append(ranges)
    return found


def front_code(suffixes: list[bytes]) -> tuple[list[int], list[bytes]]:
    shared = [0, *(common(a, b) for a, b in zip(suffixes, suffixes[1:]))]
    return shared, [s[k:] for s, k in zip(suffixes, shared)]


class LoserTree:
    """Merges sorted front-coded runs. Each run's head carries the length it shares
    with the suffix put out last, so a comparison starts behind what is known: of two
    heads the one sharing more is smaller, and only heads that share equally much are
    compared further, from there on."""

    def __init__(self, runs: list[tuple[list[int], list[bytes]]]):
        self.runs = runs
        self.size = max(1, len(runs))
        self.place = [0] * self.size
        self.head: list[bytes | None] = [rest[0] if rest else None for _, rest in runs] or [None]
        # Nothing is put out yet, so all heads share nothing with it.
        self.shared = [0] * self.size
        self.losers = [-1] * self.size
        for run in range(self.size):
            self._seat(run)

    def _beats(self, a: int, b: int) -> bool:
        """Whether head a comes before head b; updates what the loser shares with the
        winner, which is the next suffix put out on the loser's way."""
        if self.head[a] is None or self.head[b] is None:
            return self.head[a] is not None
        if self.shared[a] != self.shared[b]:
            return self.shared[a] > self.shared[b]
        x, y = self.head[a], self.head[b]
        both = common(x, y, self.shared[a])
        first = len(x) == both or (len(y) > both and x[both] < y[both])
        self.shared[b if first else a] = both
        return first

    def _seat(self, run: int) -> None:
        node = (run + self.size) >> 1
        while node:
            other = self.losers[node]
            if other < 0:
                self.losers[node] = run
                return
            if not self._beats(run, other):
                self.losers[node], run = run, other
            node >>= 1
        self.losers[0] = run

    def __iter__(self):
        """(run, place in the run, suffix, length shared with the one before)."""
        while True:
            run = self.losers[0]
            if run < 0 or self.head[run] is None:
                return
            suffix, shared = self.head[run], self.shared[run]
            yield run, self.place[run], suffix, shared
            self.place[run] += 1
            lengths, rests = self.runs[run]
            if self.place[run] < len(rests):
                self.shared[run] = lengths[self.place[run]]
                self.head[run] = suffix[: self.shared[run]] + rests[self.place[run]]
            else:
                self.head[run] = None
            node = (run + self.size) >> 1
            while node:
                other = self.losers[node]
                if not self._beats(run, other):
                    self.losers[node], run = run, other
                node >>= 1
            self.losers[0] = run


KEY = "anchor long, context long, skip int"
SHIPPED = KEY.replace("skip int", "skip int, shared int") + ", part int, lengths array<int>, rests array<binary>, anchors array<long>, contexts array<long>, skips array<int>, guards array<boolean>"


def _runs(suffixes: DataFrame, bounds: list[bytes]) -> DataFrame:
    """Sorted front-coded runs cut by range, and the suffixes settled inside a run.

    Equal suffixes of a run travel once; the others are settled at once, being
    repeated in full. Each range also gets the run's suffixes next to its borders as
    guards, so that neighbours in different ranges meet.
    """

    def sort(batch: pa.RecordBatch):
        data = batch.column("suffix").to_pylist()
        keys = [batch.column(c).to_pylist() for c in ("anchor", "context", "skip")]
        order = sorted(range(len(data)), key=data.__getitem__)
        single, again = [], []
        for i in order:
            (again if single and data[single[-1]] == data[i] else single).append(i)
        rows: list[list] = [[] for _ in range(11)]

        def put(*values):
            for column, value in zip(rows, values):
                column.append(value)

        equal = {data[i] for i in again}
        for i in again:
            put(keys[0][i], keys[1][i], keys[2][i], len(data[i]), *[None] * 7)
        for i in single:
            if data[i] in equal:
                put(keys[0][i], keys[1][i], keys[2][i], len(data[i]), *[None] * 7)
        sorted_ = [data[i] for i in single]
        cuts = [0, *(bisect_left(sorted_, b) for b in bounds), len(sorted_)]
        for part, (low, high) in enumerate(zip(cuts, cuts[1:])):
            begin, end = max(0, low - 1), min(len(sorted_), high + 1)
            if begin == end:
                continue
            lengths, rests = front_code(sorted_[begin:end])
            chosen = single[begin:end]
            guards = [not low <= place < high for place in range(begin, end)]
            put(None, None, None, None, part, lengths, rests, *([k[i] for i in chosen] for k in keys), guards)
        types = (
            pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.binary()),
            pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.bool_()),
        )
        names = "anchor context skip shared part lengths rests anchors contexts skips guards".split()
        yield pa.RecordBatch.from_arrays([*map(pa.array, rows, types)], names=names)

    # Runs are longer than other batches: their own task-side batching.
    def gather(batches):
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= RUN:
                yield from sort(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                held, count = [], 0
        if count:
            yield from sort(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return suffixes.mapInArrow(gather, SHIPPED)


ORDERED = KEY + ", part int, place int, ahead int, shared int"


def ordered(suffixes: DataFrame) -> DataFrame:
    """(anchor, context, skip, part, place, ahead, shared): the sorted suffixes, in the
    order of part and place, with the length that each shares with the one before and
    the longest that it shares with any other. Suffixes that are equal to another of
    their run have no place. ``suffixes`` has the three key columns and ``suffix``."""
    spark = suffixes.sparkSession
    count = suffixes.count()
    # Ranges of bounded length, however many suffixes there are.
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(count / RUN))
    share = min(1.0, max(SAMPLE, 4 * ranges) / max(1, count))
    seen = sorted({bytes(r[0]) for r in suffixes.select("suffix").sample(share, seed=1).collect()})
    bounds = sorted({seen[len(seen) * i // ranges] for i in range(1, ranges)}) if seen else []
    shipped = stored(_runs(suffixes, bounds), "suffix-runs")
    none = [F.lit(None).cast("int").alias(c) for c in ("part", "place", "ahead")]
    settled = shipped.filter(F.col("part").isNull()).select("anchor", "context", "skip", *none, "shared")

    def merge(rows: pa.Table, bounds_: np.ndarray):
        columns = {c: rows.column(c).to_pylist() for c in ("lengths", "rests", "anchors", "contexts", "skips", "guards")}
        parts = rows.column("part").to_pylist()
        out: list[list] = [[] for _ in range(7)]
        for low, high in zip(bounds_[:-1].tolist(), bounds_[1:].tolist()):
            runs = [(columns["lengths"][i], columns["rests"][i]) for i in range(low, high)]
            last = None

            def settle(item, after):
                if item is None or columns["guards"][item[0]][item[1]]:
                    return
                keys = (columns[name][item[0]][item[1]] for name in ("anchors", "contexts", "skips"))
                for column, value in zip(out, (*keys, parts[low], item[2], item[3], max(item[3], after))):
                    column.append(value)

            for number, (run, place, _, shared) in enumerate(LoserTree(runs)):
                settle(last, shared)
                last = low + run, place, number, shared
            settle(last, 0)
        types = (pa.int64(), pa.int64(), *[pa.int32()] * 5)
        names = ["anchor", "context", "skip", "part", "place", "ahead", "shared"]
        yield pa.RecordBatch.from_arrays([*map(pa.array, out, types)], names=names)

    merged = map_groups(
        shipped.filter(F.col("part").isNotNull()).select("part", "lengths", "rests", "anchors", "contexts", "skips", "guards"),
        ["part"], merge, ORDERED,
    )
    return settled.unionByName(merged)


def repeated_ranges(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """(h1, h2, starts): for each text the ranges of places where a repeated string
    starts. ``texts`` has h1, h2 and text, all texts different."""

    def find(batch: pa.RecordBatch):
        columns: list[list] = [[], [], [], [], []]
        rows = []
        for number, text in enumerate(batch.column("text").to_pylist()):
            found = anchors((text or "").encode("utf-8", "surrogatepass"), length)
            rows.append(np.full(len(found[0]), number))
            for column, values in zip(columns, found):
                column.append(values)
        chosen = pa.array(np.concatenate(rows), pa.int64())
        low, high, at = (np.concatenate(c).astype(np.int32) for c in columns[2:])
        arrays = [
            *(pa.array(np.concatenate(c), pa.int64()) for c in columns[:2]),
            batch.column("h1").take(chosen), batch.column("h2").take(chosen),
            pa.array(low), pa.array(high), pa.array(at),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["anchor", "context", "h1", "h2", "low", "high", "at"])

    every = map_batches(
        texts.select("h1", "h2", "text"), find,
        "anchor long, context long, h1 long, h2 long, low int, high int, at int",
    )
    # Stored before the join: between two exchanges adaptive execution can split the
    # rows of an anchor that a large share of all texts holds.
    repeated = every.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    repeated = stored(repeated, "suffix-anchors")
    candidates = stored(every.join(repeated, "anchor"), "suffix-candidates")
    contexts = candidates.groupBy("anchor", "context").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("h1", "h2", "low", "high", "at")).alias("one")
    )
    contexts = stored(contexts, "suffix-contexts")
    # Contexts with equals repeat in full. Where contexts differ, one of each is cut out.
    whole = F.struct(F.lit(0).alias("begin"), (F.col("one.high") - F.col("one.low")).alias("end"))
    full = contexts.filter("n > 1").select("anchor", "context", F.array(whole).alias("spans"))
    kinds = contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    kinds = stored(kinds, "suffix-kinds")
    differing = contexts.join(kinds, "anchor").select("anchor", "context", "kinds", "one.*")

    def cut(batch: pa.RecordBatch):
        rows = [batch.column(c).to_pylist() for c in ("text", "low", "at", "high")]
        lefts, rights = [], []
        for text, low, at, high in zip(*rows):
            data = text.encode("utf-8", "surrogatepass")
            lefts.append(data[low:at])
            rights.append(data[at : high + length])
        ends = [int.from_bytes(hashlib.blake2b(r, digest_size=8).digest(), "little", signed=True) for r in rights]
        arrays = [
            *(batch.column(c) for c in ("anchor", "context", "kinds")),
            pa.array(lefts, pa.binary()), pa.array(rights, pa.binary()), pa.array(ends, pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["anchor", "context", "kinds", "before", "behind", "end"])

    pieces = map_batches(
        differing.join(texts.select("h1", "h2", "text"), ["h1", "h2"]).select("anchor", "context", "kinds", "low", "high", "at", "text"),
        cut, "anchor long, context long, kinds long, before binary, behind binary, end long",
    )
    pieces = stored(pieces, "suffix-pieces")
    found = _near_anchors(pieces.filter(F.col("kinds") <= TOGETHER), length)
    common_ = pieces.filter(F.col("kinds") > TOGETHER)
    if not common_.isEmpty():
        found = found.unionByName(_everywhere(common_, length))
    ranges = full.unionByName(found)
    placed = candidates.select("anchor", "context", "h1", "h2", "low").join(ranges, ["anchor", "context"])
    moved = F.transform(
        "spans", lambda x: F.struct((F.col("low") + x["begin"]).alias("a"), (F.col("low") + x["end"]).alias("b"))
    )
    placed = placed.groupBy("h1", "h2").agg(F.flatten(F.collect_list(moved)).alias("starts"))
    result = stored(placed, "suffix-ranges")
    for done in (candidates, pieces):
        discard(done)
    return result


def _near_anchors(pieces: DataFrame, length: int) -> DataFrame:
    """Ranges of repeated starts. The bytes from the anchor on are sorted once per
    anchor and ending, so there are no more suffixes than contexts; what contexts
    share before the anchor is joined to that order per anchor."""
    endings = pieces.groupBy("anchor", F.col("end").alias("context")).agg(F.first("behind").alias("suffix"))
    suffixes = stored(endings.select("anchor", "context", F.lit(0).alias("skip"), "suffix"), "suffixes")
    order = ordered(suffixes).select(
        "anchor", F.lit(None).cast("long").alias("context"), F.col("context").alias("end"),
        F.lit(None).cast("binary").alias("before"), F.lit(None).cast("int").alias("size"), "part", "place", "ahead",
    )
    none = [F.lit(None).cast("int").alias(c) for c in ("part", "place", "ahead")]
    lefts = pieces.select("anchor", "context", "end", "before", F.octet_length("behind").alias("size"), *none)

    def settle(rows: pa.Table, bounds: np.ndarray):
        columns = [rows.column(c).to_pylist() for c in ("context", "end", "before", "size", "part", "place", "ahead")]
        anchor = rows.column("anchor").to_pylist()
        out: list[list] = [[], [], []]
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            context, end, before, size, part, place, ahead = (c[low:high] for c in columns)
            where = {end[i]: (part[i], place[i], ahead[i]) for i in range(high - low) if context[i] is None}
            members = [i for i in range(high - low) if context[i] is not None]
            members.sort(key=lambda i: where[end[i]][:2])
            # Equal endings follow each other and share all of theirs.
            shared = [
                size[i] if n and end[i] == end[members[n - 1]] else where[end[i]][2] if n else 0
                for n, i in enumerate(members)
            ]
            lefts_ = [before[i] for i in members]
            for i, ranges in zip(members, repeated_starts(lefts_, shared, length)):
                if ranges:
                    out[0].append(anchor[low])
                    out[1].append(context[i])
                    out[2].append([{"begin": len(before[i]) - far, "end": len(before[i]) - near} for near, far in ranges])
        spans = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [*map(pa.array, out, (pa.int64(), pa.int64(), spans))], names=["anchor", "context", "spans"]
        )

    found = map_groups(
        order.unionByName(lefts), ["anchor"], settle, "anchor long, context long, spans array<struct<begin:int,end:int>>"
    )
    return found


def _everywhere(pieces: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many contexts: all their strings are sorted."""

    def cut(batch: pa.RecordBatch):
        rows = pa.Table.from_batches([batch])
        data = [a + b for a, b in zip(rows.column("before").to_pylist(), rows.column("behind").to_pylist())]
        every = [(i, skip) for i, d in enumerate(data) for skip in range(len(d) - length + 1)]
        chosen = pa.array([i for i, _ in every], pa.int64())
        arrays = [
            batch.column("anchor").take(chosen), batch.column("context").take(chosen),
            pa.array([skip for _, skip in every], pa.int32()), pa.array([data[i][s : s + length] for i, s in every], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["anchor", "context", "skip", "suffix"])

    suffixes = stored(map_batches(pieces, cut, KEY + ", suffix binary"), "suffixes")
    repeated = ordered(suffixes).filter(F.col("shared") >= length)
    span = F.struct(F.col("skip").alias("begin"), F.col("skip").alias("end"))
    return repeated.groupBy("anchor", "context").agg(F.collect_list(span).alias("spans"))


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept), one row per input row.

    Texts are UTF-8 bytes, null is empty; matches never cross texts and are judged on
    the input. Equal texts of ``length`` bytes or more are removed whole, shorter
    texts are kept whole. ``kept`` holds the remaining bytes. Repeated rows repeat
    each other; a null id stays null; other columns are not read; an empty table
    gives no rows.
    """
    whole = F.coalesce(F.col(text_col), F.lit(""))
    keys = {"h1": F.xxhash64(whole), "h2": F.xxhash64(F.lit(1), whole)}
    rows = docs.select(F.col(id_col).alias("doc_id"), *(v.alias(k) for k, v in keys.items()))
    texts = docs.select(*(v.alias(k) for k, v in keys.items()), whole.alias("text"))
    texts = texts.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.first("text").alias("text"))
    texts = stored(texts, "suffix-texts")
    ranges = repeated_ranges(texts, length)

    def apply(batch: pa.RecordBatch):
        out: list[list] = [[], [], [], [], []]
        copies = batch.column("n").to_pylist()
        for text, n, starts in zip(batch.column("text").to_pylist(), copies, batch.column("starts").to_pylist()):
            data = text.encode("utf-8", "surrogatepass")
            if n > 1 and len(data) >= length:
                starts = [{"a": 0, "b": len(data) - length}]
            kept, removed, spans = _without(data, sorted((r["a"], r["b"] + length) for r in starts or ()))
            for column, value in zip(out, (len(data), removed, spans, hashlib.sha256(kept).hexdigest(), kept)):
                column.append(value)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        names = ["h1", "h2", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        yield pa.RecordBatch.from_arrays([batch.column("h1"), batch.column("h2"), *map(pa.array, out, types)], names=names)

    done = map_batches(
        texts.join(ranges, ["h1", "h2"], "left").select("h1", "h2", "n", "text", "starts"), apply,
        "h1 long, h2 long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary",
    )
    return rows.join(done, ["h1", "h2"]).drop("h1", "h2")


def _without(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left without some sorted spans, how many bytes go, in how many runs."""
    parts, at, end, removed, runs = [], 0, -1, 0, 0
    for low, high in spans:
        if low > end:
            runs += 1
            parts.append(data[at:low])
            removed += high - low
        else:
            removed += max(0, high - end)
        at = end = max(end, high)
    parts.append(data[at:])
    return b"".join(parts), removed, runs
