"""Mixing sources to target weights by weighted fair queueing.

Every document copy gets a virtual finish time: the words its source has offered
up to and including it, divided by the source's target. Served in the order of
finish times, sources advance in proportion to their targets, and cutting the
global order where the budget is spent leaves each source at its target. Only
DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.common import stored

# Fixed value: the characters that separate words.
SPACES = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

#: Leading hex digits of the shuffle key that name a wide and a narrow bucket of the
#: running sums. Each level splits a source 256-fold.
LEVELS = (2, 4)
#: Ranges of finish times up to the time at which the targets are used up.
RANGES = 65_536


def word_count(text: str) -> Column:
    """Words of a text; null has none. Splitting beats listing matches: no text of
    a word is copied."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int], budget_share: float, copies: int
) -> DataFrame:
    """Target words per source: shares of the budget by weight, none above
    ``copies`` times its size, the excess shared again by weight.

    ``sizes`` has one row per source: source, source_size. The water level is
    found in one pass over the sources ordered by how early they fill up. Sources may
    be many: they are ranked and summed range by range.
    """
    pattern = F.array(*(F.lit(int(w)) for w in weights))
    ranked = _running(sizes.withColumn("one", F.lit(1)), [F.col("source").asc_nulls_last()], ["one"])
    place = (F.col("one_before") % len(weights) + 1).cast("int")
    weighed = ranked.select("source", "source_size", F.element_at(pattern, place).alias("weight"))
    weighed = weighed.withColumn("cap", F.col("source_size") * copies)
    filling = [(F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last()]
    weighed = stored(_running(weighed, filling, ["cap", "weight"]), "mix-sources")
    total = weighed.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    # The level if all sources ahead are full and the others share the rest. It
    # rises up to the first source that does not fill up and falls from there on,
    # so the highest is the right one.
    rest = F.lit(float((total["size"] or 0) * float(budget_share))) - F.col("cap_before")
    level = weighed.agg(F.max(rest / (F.lit(total["weight"]) - F.col("weight_before")))).first()[0]
    target = F.least(F.col("cap").cast("double"), F.lit(level).cast("double") * F.col("weight"))
    return weighed.select("source", "source_size", target.alias("target"))


def _running(rows: DataFrame, order: list[Column], sums: list[str]) -> DataFrame:
    """``rows`` with ``<name>_before`` for each of ``sums``: the sum over all rows ahead
    in a global order. Rows are dealt to ranges; only the sums of ranges, as many as
    there are shuffle partitions, meet in one task."""
    ranges = rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    ranges = stored(ranges, "mix-ranges")
    past = (Window.unboundedPreceding, -1)
    before = {f"{n}_before": F.coalesce(F.sum(n).over(Window.orderBy("range").rowsBetween(*past)), F.lit(0)) for n in sums}
    whole = ranges.groupBy("range").agg(*(F.sum(n).alias(n) for n in sums))
    whole = whole.select("range", *(before[f"{n}_before"].alias(f"{n}_far") for n in sums))
    within = Window.partitionBy("range").orderBy(*order).rowsBetween(*past)
    near = ranges.select("*", *(F.coalesce(F.sum(n).over(within), F.lit(0)).alias(f"{n}_near") for n in sums))
    joined = near.join(whole, "range")
    return joined.select(
        *rows.columns, *((F.col(f"{n}_near") + F.col(f"{n}_far")).alias(f"{n}_before") for n in sums)
    )


def _keyed(docs: DataFrame, seed: str) -> DataFrame:
    """Shuffle key, its bucket, and the source as text that is never null."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    keyed = docs.withColumn("key", F.md5(F.concat(F.lit(seed), name)))
    return _grouped(keyed).withColumn("cell", F.substring("key", 1, LEVELS[1]))


def _grouped(rows: DataFrame) -> DataFrame:
    name = F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("+"), "source"))
    return rows.withColumn("group", name)


def _offsets(cells: DataFrame) -> DataFrame:
    """Words of the same source in all buckets ahead, from the sums per bucket."""
    wide = F.substring("cell", 1, LEVELS[0])
    within = Window.partitionBy("group", "wide").orderBy("cell")
    across = Window.partitionBy("group").orderBy("wide")
    past = (Window.unboundedPreceding, -1)
    cells = cells.withColumn("wide", wide)
    wides = cells.groupBy("group", "wide").agg(F.sum("words").alias("words"))
    wides = wides.select("group", "wide", F.coalesce(F.sum("words").over(across.rowsBetween(*past)), F.lit(0)).alias("far"))
    near = F.coalesce(F.sum("words").over(within.rowsBetween(*past)), F.lit(0))
    return (
        cells.select("group", "wide", "cell", near.alias("near"))
        .join(wides, ["group", "wide"])
        .select("group", "cell", (F.col("near") + F.col("far")).alias("ahead"))
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    budget_share: float = 1.5,
    copies: int = 2,
    seed: str = "mix",
) -> DataFrame:
    """One row per document with what the mix takes of it.

    ``docs`` has doc_id, source and size (words). Adds source_size, target (words
    of the source), taken (words over all copies) and ``start`` and ``finish``,
    the virtual times of its first copy. Copy n of a document follows all copies
    n-1 of its source. All copies of all sources queue by finish time, and the queue is
    cut where the budget, in whole words, is spent. A copy in service at that time is
    taken in part, so a source misses its target by less than a word.

    A null source is a source of its own, ordered last. Documents of no words
    take none. Repeated rows count each; equal rows are ordered arbitrarily among
    themselves, which changes no output row. An empty table gives no rows.
    """
    keyed = _keyed(docs, seed)
    thin = stored(keyed.select("group", "cell", "key", "doc_id", "source", "size"), "mix-sizes")
    cells = thin.groupBy("group", "cell").agg(F.sum("size").alias("words"), F.first("source").alias("source"))
    cells = stored(cells, "mix-cells")
    sizes = cells.groupBy("group").agg(F.first("source").alias("source"), F.sum("words").alias("source_size"))
    targets = source_targets(sizes.select("source", "source_size"), weights, budget_share, copies)
    targets = stored(_grouped(targets).drop("source"), "mix-targets")
    offsets = stored(_offsets(cells), "mix-offsets")
    order = stored(_placed(thin, offsets, targets).select("group", "before", "size", "source_size", "target"), "mix-order")
    budget = targets.agg(F.sum(F.floor("target"))).first()[0] or 0
    cut = _cut(order, budget, copies)
    # Without further columns the stored sizes are all there is to read.
    whole = thin if set(docs.columns) == {"doc_id", "source", "size"} else keyed
    rows = _placed(whole, offsets, targets)
    taken = sum((_served(packet, cut) for packet in _packets(copies)), F.lit(0))
    return rows.withColumns(
        {
            "taken": taken.cast("long"),
            "start": F.try_divide("before", "target"),
            "finish": F.try_divide(F.col("before") + F.col("size"), "target"),
        }
    ).drop("group")


def _placed(rows: DataFrame, offsets: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows with the words ``before`` them in the shuffled order of their source. One
    shuffle brings the rows of a bucket and its offset together; a source with most
    of the rows is spread over all its buckets."""
    over = Window.partitionBy("group", "cell").orderBy("key", "doc_id", "size")
    within = F.coalesce(F.sum("size").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = rows.withColumn("within", within).join(offsets, ["group", "cell"])
    placed = placed.withColumn("before", F.col("within") + F.col("ahead")).drop("within", "ahead", "cell", "key")
    return placed.join(targets, "group")


def _packets(copies: int) -> list[tuple[Column, Column]]:
    """(words, finish time) of what a row sends into the queue. A copy is one packet;
    the one that is being served at time 1, when the targets are used up, is two, cut
    after the last word that is finished then."""
    whole = F.floor("target")
    packets = []
    for n in range(copies):
        begin = F.col("before") + F.lit(n) * F.col("source_size")
        end = begin + F.col("size")
        middle = F.least(F.greatest(begin, whole), end)
        packets += [(middle - begin, F.try_divide(middle, "target")), (end - middle, F.try_divide(end, "target"))]
    return packets


def _cut(order: DataFrame, budget: int, copies: int) -> tuple[float, str, int] | None:
    """The packet with which the budget is spent, in the global order of finish times:
    its finish time and source, and the words taken of it.

    Packets are dealt to ranges of finish times, evenly filled since each source
    advances evenly; running totals over the ranges, whose number is fixed, tell the
    range in which the budget ends, and only that one is sorted.
    """
    packets = F.array(*(F.struct(words.cast("long").alias("words"), finish.alias("finish")) for words, finish in _packets(copies)))
    sent = order.select("group", F.explode(packets).alias("p")).select("group", "p.words", "p.finish").filter("words > 0")
    sent = sent.withColumn("range", F.least(F.floor(F.col("finish") * RANGES), F.lit(2 * RANGES)))
    past = (Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("words").over(Window.orderBy("range").rowsBetween(*past)), F.lit(0))
    ranges = sent.groupBy("range").agg(F.sum("words").alias("words")).withColumn("before", before)
    last = ranges.filter(F.col("before") < budget).orderBy(F.desc("range")).first()
    if last is None:
        return None
    ahead = Window.orderBy("finish", "group").rowsBetween(*past)
    before = F.coalesce(F.sum("words").over(ahead), F.lit(0)) + last["before"]
    inside = sent.filter(F.col("range") == last["range"]).withColumn("before", before)
    end = inside.filter(F.col("before") < budget).orderBy(F.desc("finish"), F.desc("group")).first()
    return end["finish"], end["group"], min(end["words"], budget - end["before"])


def _served(packet: tuple[Column, Column], cut: tuple[float, str, int] | None) -> Column:
    """Words taken of a packet, given where the budget ends."""
    if cut is None:
        return F.lit(0)
    words, finish = packet
    time, group, rest = F.lit(cut[0]), F.lit(cut[1]), F.lit(cut[2])
    ahead = (finish < time) | (finish == time) & (F.col("group") < group)
    ending = (finish == time) & (F.col("group") == group)
    return F.when(ahead, words).when(ending, F.least(words, rest)).otherwise(0)


def mixed_stream(docs: DataFrame, text_col: str = "text", copies: int = 2, **options) -> DataFrame:
    """The mix itself: the rows of ``docs`` as often as they are taken, in the
    global order of virtual finish times, cut where the budget is spent.

    Same columns as ``docs`` (doc_id, source and the text among them). The text of
    the document on the boundary ends after the words taken of it. Documents of no
    words are never taken.
    """
    # Columns move into one struct, so that no name of theirs can clash.
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    sized = docs.select("doc_id", "source", word_count(text_col).alias("size"), row)
    mixed = mix_sources(sized, copies=copies, **options)
    copy = mixed.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    copy = copy.withColumns(
        {
            "part": F.greatest(F.lit(0), F.least(F.col("size"), F.col("taken") - F.col("n") * F.col("size"))),
            "finish": F.try_divide(F.col("before") + F.col("n") * F.col("source_size") + F.col("size"), "target"),
        }
    ).filter("part > 0")
    pieces = F.split(F.col(f"row.{text_col}"), f"(?<={SPACES})(?=[^\\x20\\x09-\\x0D])")
    lead = F.col(f"row.{text_col}").rlike(f"^{SPACES}").cast("int")
    cut = F.array_join(F.slice(pieces, F.lit(1), (F.col("part") + lead).cast("int")), "")
    text = F.when(F.col("part") < F.col("size"), cut).otherwise(F.col(f"row.{text_col}"))
    ordered = copy.select("finish", "n", "doc_id", "row", text.alias("shown"))
    ordered = ordered.repartitionByRange("finish", "doc_id").sortWithinPartitions("finish", "doc_id")
    return ordered.select(
        *(F.col("shown").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns)
    )
