"""Phrase collocations by stripes.

A stripe is what follows one prefix: an associative counter of next words. Tasks
count stripes of the text they read, stripes of one prefix are merged elementwise, and the
merged stripes give all that is asked at once: the frequencies of a prefix's extensions,
the most frequent of them, and, as an entry in the stripe of the prefix one word shorter,
the total of the prefix itself. Prefixes grow by a word per level, and a level only counts
where both the prefix and the words that end with the next one were frequent before.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.common import find_package, lists, map_batches, stored

# What ends a piece, and the name of a missing language.
ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
NO_LANG = "und"

#: No UTF-8 text holds this byte, so it can stand for the end of a piece.
BREAK = b"\xff"
#: A-Z in lower case, ends of pieces as breaks; blanks and tabs separate words.
FOLDED = bytes(BREAK[0] if b in ENDS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))

#: Bytes of text a task counts before it hands its stripes on.
CHUNK = 1 << 24
#: Parts of the stripe of a prefix that at least one word in ``HOT`` is.
SHARDS, HOT = 256, 1024
#: Bits of the filter that tells frequent phrases apart, and the seed of its hashes.
BITS, SEED = 1 << 24, 42

#: The next words of a stripe travel as one text, as none holds a blank, and their
#: counts as 8 bytes each.
STRIPE = "lang string, prefix string, shard int, nexts string, counts binary"
MERGED = "lang string, prefix string, shard int, total long, most long, nexts array<string>, counts array<long>"


def _hash(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data, SEED)


def _chain(code: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of the phrase before its last word."""
    mixed = (code ^ word) * np.uint64(0x9E3779B97F4A7C15)
    return mixed ^ (mixed >> np.uint64(29))


def phrase_hashes(langs: list[str], phrases: list[str]) -> np.ndarray:
    """Hash of each phrase of a language, as tasks compute it from text."""
    split = [phrase.encode("utf-8", "surrogatepass").split(b" ") for phrase in phrases]
    code = np.array([_hash(lang.encode()) for lang in langs], dtype=np.uint64)
    for place in range(max(map(len, split), default=0)):
        has = np.array([len(words) > place for words in split])
        words = np.array([_hash(words[place]) for words in split if len(words) > place], dtype=np.uint64)
        code[has] = _chain(code[has], words)
    return code


def _spots(codes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    low = codes & np.uint64(bits - 1)
    high = (codes >> np.uint64(32)) & np.uint64(bits - 1)
    return low.astype(np.int64), high.astype(np.int64)


@dataclass(frozen=True)
class Frequent:
    """Frequent phrases of one length, as a filter of ``BITS`` bits whatever their
    number, and the hashes of the at most ``HOT`` hottest. The filter lets through some
    others too, which costs their counting and changes no result."""

    bits: np.ndarray
    hot: np.ndarray

    def holds(self, codes: np.ndarray) -> np.ndarray:
        found = np.ones(len(codes), dtype=bool)
        for spot in _spots(codes, 64 * len(self.bits)):
            found &= (self.bits[spot >> 6] >> (spot & 63)) & 1 == 1
        return found


def _filter(phrases: DataFrame, words: int) -> Frequent:
    """The filter of (lang, phrase, f); ``words`` is the number of all words counted."""

    size = BITS

    def spots(batch: pa.RecordBatch):
        codes = phrase_hashes(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist())
        spot = np.concatenate(_spots(codes, size))
        bit = np.left_shift(np.int64(1), spot & 63)
        yield pa.RecordBatch.from_arrays([pa.array(spot >> 6), pa.array(bit)], names=["slot", "bit"])

    found = map_batches(phrases.select("lang", "phrase"), spots, "slot long, bit long")
    set_ = found.groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(size // 64, dtype=np.int64)
    bits[set_.column("slot").to_numpy()] = set_.column("bits").to_numpy()
    hot = phrases.filter(F.col("f") > words // HOT).select("lang", "phrase").collect()
    codes = phrase_hashes([r["lang"] for r in hot], [r["phrase"] for r in hot])
    return Frequent(bits, codes)


class _Chunk:
    """Texts read so far."""

    def __init__(self):
        self.langs: dict[str, int] = {}
        self.owners: list[int] = []
        self.texts: list[bytes] = []
        self.size = 0

    def add(self, lang: str, text: bytes) -> None:
        self.owners.append(self.langs.setdefault(lang, len(self.langs)))
        self.texts.append(text.translate(FOLDED).replace(BREAK, b" \xff ") + b" \xff")
        self.size += len(text)

    def _words(self) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """All words as numbers with 0 for breaks, their languages, and their texts."""
        split = pc.split_pattern(pa.array(self.texts, pa.binary()), " ")
        lang = np.repeat(np.array(self.owners, dtype=np.int64), np.diff(split.offsets.to_numpy()))
        coded = split.flatten().dictionary_encode()
        names, found = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        # Numbers change places so that the break has 0; there is one after each text.
        number = names.index(BREAK)
        order = np.arange(len(names))
        order[[0, number]] = order[[number, 0]]
        names[0], names[number] = names[number], names[0]
        word = order[found]
        if b"" in names:
            some = word != names.index(b"")
            word, lang = word[some], lang[some]
        return word, lang, names

    def stripes(self, width: int, frequent: Frequent | None) -> Iterator[pa.RecordBatch]:
        """The stripes of all prefixes of ``width`` words."""
        word, lang, names = self._words()
        hashes = np.fromiter(map(_hash, names), dtype=np.uint64, count=len(names))
        if width == 0:
            at, hot = np.flatnonzero(word), None
        else:
            of_lang = np.fromiter((_hash(name.encode()) for name in self.langs), dtype=np.uint64, count=len(self.langs))
            at, codes = self._frequent(word, of_lang[lang], hashes, width, frequent)
            held = np.zeros(len(word) + 1, dtype=bool)
            held[at] = True
            # The phrase that begins a word later holds the next word; no break is in it.
            some = held[at + 1]
            at, hot = at[some], np.isin(codes[some], frequent.hot)
        if not len(at):
            return
        base = len(names)
        code = lang[at]
        for place in range(width + 1):
            code = _dense(code, base) * base + word[at + place]
        order = np.argsort(code)
        code = code[order]
        starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        counts, at, first = np.diff(np.r_[starts, len(code)]), at[order[starts]], order[starts]
        prefix, following = code[starts] // base, word[at + width]
        shard = (hashes[following] % np.uint64(SHARDS)).astype(np.int64)
        if hot is not None:
            shard[~hot[first]] = 0
        order = np.lexsort((shard, prefix))
        prefix, shard, following, counts, at = prefix[order], shard[order], following[order], counts[order], at[order]
        starts = np.flatnonzero(np.r_[True, (prefix[1:] != prefix[:-1]) | (shard[1:] != shard[:-1])])
        shown = pa.array([b"", *names[1:]], pa.binary()).cast(pa.string())
        own = at[starts]
        if width:
            texts = pc.binary_join_element_wise(*(shown.take(word[own + place]) for place in range(width)), " ")
        else:
            texts = pa.array([""] * len(own), pa.string())
        offsets = np.r_[starts, len(following)].astype(np.int32)
        packed = pa.py_buffer(counts.astype("<i8").tobytes())
        columns = [
            pa.array(list(self.langs), pa.string()).take(lang[own]),
            texts,
            pa.array(shard[starts].astype(np.int32)),
            pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), shown.take(following)), " "),
            pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets * 8), packed]),
        ]
        made = pa.RecordBatch.from_arrays(columns, names=["lang", "prefix", "shard", "nexts", "counts"])
        for begin in range(0, made.num_rows, 1 << 14):
            yield made.slice(begin, 1 << 14)

    def _frequent(self, word, code, hashes, width, frequent) -> tuple[np.ndarray, np.ndarray]:
        """Places where a frequent phrase of ``width`` words begins, and its hash."""
        at = np.flatnonzero(word)
        code = code[at]
        for place in range(width):
            there = at + place
            inside = there < len(word)
            at, code, there = at[inside], code[inside], there[inside]
            whole = word[there] > 0
            at, code, there = at[whole], code[whole], there[whole]
            code = _chain(code, hashes[word[there]])
        held = frequent.holds(code)
        return at[held], code[held]


def _dense(codes: np.ndarray, base: int) -> np.ndarray:
    """Codes numbered afresh, in the same order, before they outgrow 64 bits."""
    if len(codes) and int(codes.max()) * base >= 1 << 61:
        return np.unique(codes, return_inverse=True)[1]
    return codes


def stripes(docs: DataFrame, width: int, frequent: Frequent | None = None) -> DataFrame:
    """Stripes of (lang, text) as tasks count them, several per prefix."""
    find_package(docs.sparkSession)
    full = CHUNK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk()
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for lang, text in zip(batch.column("lang").to_pylist(), texts):
                chunk.add(lang, text)
                if chunk.size >= full:
                    yield from chunk.stripes(width, frequent)
                    chunk = _Chunk()
        if chunk.size:
            yield from chunk.stripes(width, frequent)

    return docs.mapInArrow(run, STRIPE)


def merge_stripes(parts: DataFrame, least: int) -> DataFrame:
    """One stripe per (lang, prefix, shard), added up elementwise: the total over all its
    next words, the most frequent one's count, and those that occur ``least`` times.

    A task holds one merged stripe at a time, whatever the number of its parts.
    """
    find_package(parts.sparkSession)
    keys = ["lang", "prefix", "shard"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _unpacked(batch)
            rows = rows if held is None else pa.concat_tables([held, rows])
            merged = _added(rows.combine_chunks(), keys)
            if merged.num_rows > 1:
                yield _summed(merged.slice(0, merged.num_rows - 1), least)
            held = merged.slice(merged.num_rows - 1)
        if held is not None:
            yield _summed(held, least)

    return parts.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, MERGED)


def _unpacked(batch: pa.RecordBatch) -> pa.Table:
    packed = batch.column("counts")
    offsets = np.frombuffer(packed.buffers()[1], dtype=np.int32)[packed.offset : packed.offset + len(packed) + 1]
    counts = np.frombuffer(packed.buffers()[2], dtype="<i8")[offsets[0] // 8 : offsets[-1] // 8]
    bounds = pa.array((offsets - offsets[0]) // 8)
    columns = {key: batch.column(key) for key in ("lang", "prefix", "shard")}
    columns["nexts"] = pc.split_pattern(batch.column("nexts"), " ")
    columns["counts"] = pa.ListArray.from_arrays(bounds, pa.array(counts))
    return pa.table(columns)


def _added(rows: pa.Table, keys: list[str]) -> pa.Table:
    """Stripes in key order, added up."""
    changed = np.zeros(rows.num_rows, dtype=bool)
    for key in keys:
        column = rows.column(key).combine_chunks()
        differs = pc.not_equal(column.slice(1), column.slice(0, rows.num_rows - 1))
        changed[1:] |= differs.to_numpy(zero_copy_only=False)
    group = np.cumsum(changed)
    firsts = np.flatnonzero(np.r_[True, changed[1:]])
    nexts = rows.column("nexts").combine_chunks()
    counts, offsets = lists(rows.column("counts"))
    words = nexts.flatten().dictionary_encode()
    code = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = max(1, len(words.dictionary))
    key = np.repeat(group, np.diff(offsets)) * size + code
    order = np.argsort(key)
    key = key[order]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sums = np.add.reduceat(counts[order], starts)
    owner, code = key[starts] // size, key[starts] % size
    bounds = pa.array(np.searchsorted(owner, np.arange(len(firsts) + 1)).astype(np.int32))
    columns = {key: rows.column(key).take(pa.array(firsts)) for key in keys}
    columns["nexts"] = pa.ListArray.from_arrays(bounds, words.dictionary.take(pa.array(code)))
    columns["counts"] = pa.ListArray.from_arrays(bounds, pa.array(sums))
    return pa.table(columns)


def _summed(merged: pa.Table, least: int) -> pa.RecordBatch:
    counts, offsets = lists(merged.column("counts"))
    nexts = merged.column("nexts").combine_chunks().flatten()
    total = np.add.reduceat(counts, offsets[:-1])
    real = counts >= least
    most = np.maximum.reduceat(counts, offsets[:-1])
    kept = np.r_[0, np.cumsum(real)][offsets].astype(np.int32)
    columns = [
        *(merged.column(key).combine_chunks() for key in ("lang", "prefix", "shard")),
        pa.array(total),
        pa.array(most),
        pa.ListArray.from_arrays(pa.array(kept), nexts.filter(pa.array(real))),
        pa.ListArray.from_arrays(pa.array(kept), pa.array(counts[real])),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "prefix", "shard", "total", "most", "nexts", "counts"])


def _extensions(merged: DataFrame) -> DataFrame:
    """(lang, phrase, f) of the frequent extensions of all prefixes."""
    pair = F.explode(F.arrays_zip("nexts", "counts")).alias("pair")
    one = merged.select("lang", "prefix", pair)
    phrase = F.when(F.col("prefix") == "", F.col("pair.nexts")).otherwise(F.concat_ws(" ", "prefix", "pair.nexts"))
    return one.select("lang", phrase.alias("phrase"), F.col("pair.counts").alias("f"))


def collocations(
    docs: DataFrame,
    least: int = 30,
    longest: int = 4,
    top: int = 2000,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the best ``top`` phrases per language.

    Phrases are 2 to ``longest`` words in a row inside a piece of text. a, l and r count
    the phrase and the two parts at its weakest cut, n all words of the language; score
    is floor(2000000 * a / (l + r)) at that cut, of equal ones the earliest. Phrases of
    fewer than ``least`` occurrences take no part. A phrase is dropped where one that is
    a word longer, holds it and takes part has at least 0.8 of its occurrences; longer
    ones that hold it occur no more often than that. Order: score, a, phrase.

    A null text is empty, a null language ``und``. Repeated rows count each. Texts of any
    length are read whole; a task keeps the words of about ``CHUNK`` places at once, or of
    one document. Other columns are not read. An empty table gives no rows.
    """
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    merged = stored(merge_stripes(stripes(rows, 0), least), "stripes-0")
    sizes = merged.groupBy("lang").agg(F.sum("total").alias("n"))
    words = merged.agg(F.sum("total")).first()[0] or 0
    found = [_extensions(merged)]
    most = []
    for width in range(1, longest):
        frequent = _filter(found[-1], words)
        merged = stored(merge_stripes(stripes(rows, width, frequent), least), f"stripes-{width}")
        found.append(_extensions(merged))
        most.append(merged.select("lang", F.col("prefix").alias("phrase"), "most"))

    def union(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    candidates = union(found[1:]).select("lang", "phrase", F.col("f").alias("a"))
    scored = _scored(_not_covered(candidates, union(most), least), union(found[:-1]))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # A language with most of the phrases is first cut down in parts.
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    best = scored.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= top).drop("rank")
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    best = best.filter(F.col("rank") <= top)
    return best.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _not_covered(candidates: DataFrame, most: DataFrame, least: int) -> DataFrame:
    """Candidates that no candidate a word longer covers: the stripe of the phrase tells
    its most frequent extension to the right, the phrases keyed by all but their first
    word those to the left."""
    tail = F.expr("substring(phrase, instr(phrase, ' ') + 1)")
    longer = candidates.select("lang", tail.alias("phrase"), F.col("a").alias("most")).filter(F.instr("phrase", " ") > 0)
    # Parts of one stripe, and both sides, by one maximum per phrase.
    sides = longer.unionByName(most.filter(F.col("most") >= least)).groupBy("lang", "phrase").agg(F.max("most").alias("most"))
    both = candidates.join(sides, ["lang", "phrase"], "left")
    return both.filter(F.coalesce("most", F.lit(0)) * 5 < F.col("a") * 4).select("lang", "phrase", "a")


def _scored(candidates: DataFrame, phrases: DataFrame) -> DataFrame:
    """Adds l, r and score of the weakest cut; ``phrases`` has the totals of its parts."""
    words = F.split("phrase", " ")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.size(words) - 1)))
    cuts = cuts.select(
        "*",
        F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice(words, F.col("k") + 1, F.size(words)), " ").alias("rest"),
    )
    left = phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    counted = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    # Whole division of decimals is exact; the product passes 64 bits.
    score = F.expr("(CAST(a AS DECIMAL(25,0)) * 2000000) div (CAST(l AS DECIMAL(25,0)) + CAST(r AS DECIMAL(25,0)))")
    weakest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    found = counted.groupBy("lang", "phrase", "a").agg(weakest)
    return found.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
