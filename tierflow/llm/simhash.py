"""SimHash near-duplicates, searched with tables of distances to reference fingerprints.

Hamming distance is a metric, so the distances of two fingerprints to any
reference differ by at most their own distance. Fingerprints that agree in their
tables meet in a cell, pairs whose coordinates differ too much are discarded and
only the survivors are compared.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import map_batches, stored
from tierflow.llm.components import components

BITS = 64
#: Blocks of bits with a distance table of their own. A pair at distance 2 differs
#: in at most two blocks, so the tables of at least three are equal.
BLOCKS = ((0, 13), (13, 26), (26, 39), (39, 52), (52, 64))
#: References per block, and references over all bits.
PER_BLOCK, OVERALL = 14, 8
#: Cells with more fingerprints than this are linked through shared neighbours.
CELL = 32


def shingle_hashes(text: str | None, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each shingle of lower-cased words, repeats included."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    if len(found) <= words:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(words))))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(s, seed) for s in shingles), dtype=np.uint64)


def fingerprint(hashes: np.ndarray, chunk: int = 1 << 15) -> int:
    """Each bit is 1 if it is set in over half the hashes; 0 for no hashes."""
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), chunk):
        part = hashes[at : at + chunk].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(
    docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, mark, fp) of each row: ``mark`` is a hash that tells the texts of one
    id apart. A null text has no words and fingerprint 0."""

    def compute(batch: pa.RecordBatch):
        values = [fingerprint(shingle_hashes(t, words)) for t in batch.column(2).to_pylist()]
        columns = [batch.column(0), batch.column(1), pa.array(values, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "mark", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), _mark(text_col).alias("mark"), F.col(text_col).alias("text"))
    return map_batches(rows, compute, f"doc_id {kind}, mark long, fp long")


def _mark(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def _references(seed: int, n: int) -> list[int]:
    return [int(v) for v in np.random.default_rng(seed).integers(-(2**63), 2**63 - 1, n)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _coordinates(references: list[int], width: int, mask: int = -1) -> Column:
    """Distances to the references, ``width`` bits each, packed into one number."""
    packed = F.lit(0).cast("long")
    for place, reference in enumerate(references):
        distance = F.bit_count(F.col("fp").bitwiseXOR(F.lit(reference)).bitwiseAND(F.lit(mask)))
        packed = packed.bitwiseOR(F.shiftleft(distance.cast("long"), place * width))
    return packed


def distance_tables(fps: DataFrame) -> DataFrame:
    """Adds ``t0`` to ``t4``, the distances to the references of each block, and
    ``overall``, those to the references over all bits."""
    columns = {}
    for number, (low, high) in enumerate(BLOCKS):
        mask = _signed(((1 << high) - 1) ^ ((1 << low) - 1))
        columns[f"t{number}"] = _coordinates(_references(number, PER_BLOCK), 4, mask)
    columns["overall"] = _coordinates(_references(99, OVERALL), 8)
    return fps.withColumns(columns)


def close_links(fps: DataFrame, distance: int = 2) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that connect all pairs within
    ``distance`` (0 to 2) bits: every such pair is an edge or is joined by edges
    of other such pairs.

    Cells of up to ``CELL`` fingerprints compare their pairs. In larger ones each
    member is linked with the others through the fingerprints one bit away: two
    that share such a neighbour are within two bits, and two within two bits share
    one, so the smallest of those around a neighbour stands for all. Nothing is
    dropped and no cell makes all its pairs.
    """
    if not 0 <= distance <= 2:
        raise ValueError("distances of 0 to 2 bits are supported")
    agree = [F.array(*(F.col(f"t{n}") for n in trio)) for trio in combinations(range(len(BLOCKS)), 3)]
    keys = F.array(*(F.xxhash64(F.lit(i), key) for i, key in enumerate(agree)))
    cells = distance_tables(fps).select("fp", "overall", F.explode(keys).alias("cell"))
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = stored(cells.join(sizes, "cell"), "simhash-cells")

    few = met.filter(F.col("n") <= CELL).select("cell", "fp", "overall")
    a, b = few.alias("a"), few.alias("b")
    same = (F.col("a.cell") == F.col("b.cell")) & (F.col("a.fp") < F.col("b.fp"))
    for place in range(OVERALL):
        of = lambda side: F.shiftright(F.col(f"{side}.overall"), 8 * place).bitwiseAND(F.lit(255))  # noqa: E731, B023
        same &= F.abs(of("a") - of("b")) <= distance
    near = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= distance
    pairs = a.join(b, same & near).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    if distance == 0:
        return pairs.limit(0)

    crowd = met.filter(F.col("n") > CELL).select("fp").distinct()
    return pairs.unionByName(_through_neighbours(crowd, distance)).distinct()


def _through_neighbours(fps: DataFrame, distance: int) -> DataFrame:
    """Edges from each fingerprint to the smallest one around each fingerprint that
    is at most one bit away (``distance`` 1: to those one bit away itself)."""
    flips = [F.lit(0).cast("long"), *(F.lit(_signed(1 << bit)) for bit in range(BITS))]
    around = fps.select("fp", F.explode(F.array(*(F.col("fp").bitwiseXOR(f) for f in flips))).alias("spot"))
    if distance == 1:
        own = fps.select(F.col("fp").alias("spot"), F.col("fp").alias("a"))
        return around.filter("fp < spot").join(own, "spot").select("a", F.col("fp").alias("b"))
    least = around.groupBy("spot").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    linked = around.join(least.drop("n"), "spot").filter("fp <> b")
    return linked.select(F.col("fp").alias("a"), "b").distinct()


def _labelled(docs: DataFrame, words: int, distance: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, mark, fp, component, component_id) of each row; ``component`` is the
    smallest fingerprint that links reach."""
    marked = stored(fingerprints(docs, words, id_col, text_col), "simhash")
    # Copies collapse first: one row per distinct fingerprint from here on.
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    distinct = stored(distinct, "simhash-distinct")
    grouped = components(close_links(distinct.select("fp"), distance))
    named = distinct.join(grouped.withColumnRenamed("node", "fp"), "fp", "left")
    named = named.select("fp", "least", F.coalesce("component", "fp").alias("component"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = named.join(smallest, "component").select("fp", "component", "component_id")
    return marked.join(labels, "fp")


def simhash_components(
    docs: DataFrame,
    words: int = 3,
    distance: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per input row.

    Rows link when their fingerprints differ in ``distance`` bits or fewer;
    component_id is the smallest doc_id that links reach, the row's own included.
    Equal texts, repeated rows and texts without words (null, empty, blank) have
    equal fingerprints and link like any others. A null id is no smallest id: its
    row takes the smallest other id of its component, or null. Other columns are
    not read. An empty table gives no rows.
    """
    return _labelled(docs, words, distance, id_col, text_col).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_per_group(
    docs: DataFrame,
    words: int = 3,
    distance: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with one row of each group of linked fingerprints, all columns kept.

    The row with the smallest id of its group stays; of equal rows one, of different
    texts under that id one. A row with a null id stays only if its group has no other
    id. Links are those of :func:`simhash_components`. An empty table gives no rows.
    """
    labelled = _labelled(docs, words, distance, id_col, text_col)
    same = labelled.groupBy("component", "doc_id", "mark").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark", "n")
    first = same.groupBy("component").agg(F.min(order).alias("first"))
    stay = first.select(
        F.col("first.doc_id").alias("__id"), F.col("first.mark").alias("__mark"), F.col("first.n").alias("__n")
    )
    # Keyed by id and text, so that a large group of copies is no large group here.
    found = (F.col("__mark") == F.col("__own")) & F.col(id_col).eqNullSafe(F.col("__id"))
    rows = docs.withColumn("__own", _mark(text_col)).join(stay, found)
    repeated = rows.filter("__n > 1").dropDuplicates(["__own", "__id"])
    return rows.filter("__n = 1").unionByName(repeated).select(*(F.col(f"`{c}`") for c in docs.columns))
