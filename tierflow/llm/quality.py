"""Quality classifier from weak labels.

Heuristic labellers vote on each text (good, bad or no opinion). Expectation
maximisation over the counts of all vote patterns estimates how often each labeller
is right, without any true label. The posterior of a pattern is the soft label from
which a linear scorer over hashed features learns.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import map_batches

#: Hashed feature space, and the bound on the sample the scorer is fitted on.
DIMENSIONS, SAMPLE = 1 << 12, 4000

GOOD, BAD, NONE = "+", "-", "."

# Fixed value: characters that prose seldom attaches to words.
SYMBOLS = b"#$%&*+/<=>@[\\]^_`{|}~"

_CLASSES = np.arange(256, dtype=np.uint8)
_CLASSES[ord("a") : ord("z") + 1] = ord("a")
_CLASSES[128:] = ord("a")
_CLASSES[ord("A") : ord("Z") + 1] = ord("A")
_CLASSES[ord("0") : ord("9") + 1] = ord("0")
_CLASSES[[9, 10, 11, 12, 13]] = ord(" ")


@dataclass(frozen=True)
class Facts:
    """What the labellers look at, over the whole text."""

    words: int
    symbols: float  # symbol characters per word
    shouting: float  # upper-case share of the ASCII letters
    exclaiming: float  # exclamation marks per word
    stuttering: float  # words equal to the one before
    repeating: float  # words in three-word runs seen before in the text
    plain: float  # share of words of letters with at most one mark behind
    stops: float  # sentence ends per word
    length: float  # bytes per word


def facts(data: bytes) -> Facts:
    words = data.split()
    n = len(words)
    if not n:
        return Facts(0, *[0.0] * 8)
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    upper, lower = counts[65:91].sum(), counts[97:123].sum()
    runs = list(zip(words, words[1:], words[2:]))
    stripped = b" ".join(words).translate(None, b".,;:!?")
    plain = sum(map(bytes.isalpha, stripped.translate(_LETTERS).split()))
    return Facts(
        n,
        float(counts[list(SYMBOLS)].sum()) / n,
        float(upper) / max(1, float(upper + lower)),
        float(counts[33]) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        1 - len(set(runs)) / len(runs) if runs else 0.0,
        plain / n,
        float(counts[[46, 63]].sum()) / n,
        len(data) / n,
    )


#: Non-ASCII bytes count as letters.
_LETTERS = bytes(b if b < 128 else ord("a") for b in range(256))


def _vote(value: float, good: float, bad: float) -> str:
    """Good up to ``good``, bad from ``bad`` on (or the other way round)."""
    if good < bad:
        return GOOD if value <= good else BAD if value >= bad else NONE
    return GOOD if value >= good else BAD if value <= bad else NONE


def votes(seen: Facts) -> str:
    """One character per labeller. A text without words is bad to all of them."""
    if not seen.words:
        return BAD * 8
    return "".join(
        (
            _vote(seen.symbols, 0.1, 0.4),
            _vote(seen.shouting, 0.25, 0.6),
            _vote(seen.exclaiming, 0.05, 0.3),
            _vote(seen.stuttering, 0.06, 0.25),
            _vote(seen.repeating, 0.3, 0.6),
            _vote(seen.plain, 0.8, 0.5),
            BAD if seen.stops > 0.6 else GOOD if 0.01 <= seen.stops <= 0.5 else NONE,
            BAD if not 2 <= seen.length <= 25 else GOOD if 3.5 <= seen.length <= 14 else NONE,
        )
    )


def features(data: bytes, seen: Facts) -> dict[int, float]:
    """Hashed features: word shapes (runs of a character class as one), each by its
    share of the words, and the facts."""
    found: dict[int, float] = {}

    def add(name: bytes, value: float) -> None:
        place = xxhash.xxh32_intdigest(name) % DIMENSIONS
        found[place] = found.get(place, 0.0) + value

    classes = _CLASSES[np.frombuffer(data, dtype=np.uint8)]
    if len(classes):
        squeezed = classes[np.concatenate([[True], classes[1:] != classes[:-1]])].tobytes().split()
        for shape, count in sorted(Counter(squeezed).items()):
            add(b"shape " + shape, count / len(squeezed))
    for name in ("symbols", "shouting", "exclaiming", "stuttering", "repeating", "plain", "stops"):
        add(f"fact {name}".encode(), min(2.0, getattr(seen, name)))
    add(b"always", 1.0)
    return found


def _examine(keyed: DataFrame) -> DataFrame:
    """(key, votes, places, values) per row."""

    def look(batch: pa.RecordBatch):
        out: list[list] = [[], [], []]
        for text in batch.column(1).to_pylist():
            data = (text or "").encode("utf-8", "surrogatepass")
            seen = facts(data)
            found = features(data, seen)
            out[0].append(votes(seen))
            out[1].append(list(found))
            out[2].append(list(found.values()))
        types = (pa.string(), pa.list_(pa.int32()), pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *map(pa.array, out, types)], names=["key", "votes", "places", "values"]
        )

    return map_batches(keyed, look, "key long, votes string, places array<int>, values array<float>")


def estimate_accuracies(
    counts: dict[str, int], rounds: int = 100
) -> tuple[float, np.ndarray, dict[str, float]]:
    """Expectation maximisation over vote patterns.

    Returns the share of good texts, the probability of each vote given the class
    (labeller, class, vote), and each pattern's posterior of being good. The first
    posterior is the share of good votes, which settles which class is which.
    """
    patterns = sorted(counts)
    if not patterns:
        return 0.5, np.zeros((0, 2, 3)), {}
    kinds = {BAD: 0, GOOD: 1, NONE: 2}
    cast = np.array([[kinds[v] for v in p] for p in patterns])
    weight = np.array([counts[p] for p in patterns], dtype=float)
    for_it, against = (cast == 1).sum(axis=1), (cast == 0).sum(axis=1)
    # A bad vote weighs three times: each labeller knows one kind of junk, so a junk text
    # still gets good votes from the others.
    posterior = (for_it + 0.5) / (for_it + 3.0 * against + 1.0)
    shown = np.eye(3)[cast]  # pattern, labeller, vote
    for _ in range(rounds):
        share = float((weight * posterior).sum() / weight.sum())
        share = min(max(share, 1e-4), 1 - 1e-4)
        given = np.stack(
            [np.einsum("p,plv->lv", weight * side, shown) + 0.1 for side in (1 - posterior, posterior)], axis=1
        )
        given /= given.sum(axis=2, keepdims=True)
        logs = np.einsum("plv,lcv->pc", shown, np.log(given)) + np.log([1 - share, share])
        before, posterior = posterior, 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -50, 50)))
        if np.abs(posterior - before).max() < 1e-6:
            break
    return share, given, dict(zip(patterns, posterior.tolist()))


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    #: Posterior of each vote pattern that was seen.
    posterior: dict[str, float]

    def score(self, found: dict[int, float]) -> float:
        total = sum(self.weights[place] * value for place, value in found.items())
        return float(1 / (1 + np.exp(-np.clip(total, -50, 50))))


def _fit_scorer(x: np.ndarray, target: np.ndarray, steps: int = 300, rate: float = 0.1) -> np.ndarray:
    """Logistic regression on soft labels by Adam over the whole sample."""
    used = np.flatnonzero(x.any(axis=0)) if len(x) else np.zeros(0, dtype=int)
    small, weights = x[:, used], np.zeros(len(used))
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    # Both classes weigh alike, whatever their shares.
    good = max(float(target.sum()), 1.0)
    bad = max(float(len(target) - target.sum()), 1.0)
    balance = target / good + (1 - target) / bad
    for step in range(1, steps + 1):
        predicted = 1 / (1 + np.exp(-np.clip(small @ weights, -50, 50)))
        slope = small.T @ ((predicted - target) * balance) + 1e-4 * weights
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        weights -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    full = np.zeros(DIMENSIONS)
    full[used] = weights
    return full


def fit_quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE
) -> QualityModel:
    """Votes of all rows are counted; the scorer learns from about ``sample`` different
    rows, those whose hash lies in the share of all hashes that this is of the rows.
    Only pattern counts (at most 3 to the number of labellers) and the sample's
    features reach the driver."""
    keyed = docs.select(F.xxhash64(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    looked = _examine(keyed)
    counts = {r["votes"]: r["n"] for r in looked.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    _, _, posterior = estimate_accuracies(counts)
    share = min(1.0, sample / max(1, sum(counts.values())))
    bound = min(2**63 - 1, round(share * 2**64) - 2**63)
    rows = _examine(keyed.filter(F.col("key") <= bound).dropDuplicates(["key"])).orderBy("key").collect()
    x = np.zeros((len(rows), DIMENSIONS), dtype=np.float32)
    for number, row in enumerate(rows):
        x[number, row["places"]] = row["values"]
    target = np.array([posterior[row["votes"]] for row in rows])
    return QualityModel(_fit_scorer(x, target), posterior)


def _scores(model: QualityModel, texts: list[str | None]) -> tuple[list[str], list[float]]:
    patterns, scores = [], []
    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass")
        seen = facts(data)
        patterns.append(votes(seen))
        # Without words there is nothing to score.
        scores.append(model.score(features(data, seen)) if seen.words else 0.0)
    return patterns, scores


def score_quality(
    docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5
) -> DataFrame:
    """(doc_id, votes, weak_label, score, keep), one row per input row.

    ``weak_label`` is the posterior of the votes, ``score`` that of the linear
    scorer; a row is kept from a score of ``least`` on. A null, empty or blank text
    has score 0. Repeated rows score alike; other columns are not read.
    """

    def score(batch: pa.RecordBatch):
        patterns, scores = _scores(model, batch.column(1).to_pylist())
        weak = [model.posterior.get(p) for p in patterns]
        columns = [
            batch.column(0), pa.array(patterns, pa.string()), pa.array(weak, pa.float64()),
            pa.array(scores, pa.float64()), pa.array([s >= least for s in scores], pa.bool_()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "votes", "weak_label", "score", "keep"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, votes string, weak_label double, score double, keep boolean"
    return map_batches(docs.select(id_col, text_col), score, schema)


def keep_quality(
    docs: DataFrame, model: QualityModel, text_col: str = "text", least: float = 0.5
) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, with all their columns."""
    place = docs.columns.index(text_col)

    def keep(batch: pa.RecordBatch):
        _, scores = _scores(model, batch.column(place).to_pylist())
        yield batch.filter(pa.array([s >= least for s in scores], pa.bool_()))

    return map_batches(docs, keep, docs.schema)
