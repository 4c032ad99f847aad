"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the bytes of a word in both directions and labels every position;
a document's probabilities are the mean over all its positions. State starts afresh
with each word, so a word's labels are the same wherever it stands and are computed
once per task. Trained in numpy by backpropagation through time.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.common import map_batches

UNDETERMINED = "und"
#: Words are runs of ASCII letters and non-ASCII bytes, lower-cased.
WORDS = re.compile(rb"[a-z\x80-\xff]+")
#: Longer words are read in parts of this many bytes.
STEPS = 24

#: Bounds of the training sample: documents and words per language.
SAMPLE_DOCS, SAMPLE_WORDS = 200, 5000
HIDDEN = 16
#: Words remembered per Python process, and their bytes, before the memory is emptied.
MEMORY, MEMORY_BYTES = 400_000, 1 << 25


def words_of(text: str | None) -> list[bytes]:
    return WORDS.findall((text or "").lower().encode("utf-8", "ignore"))


def parts_of(word: bytes) -> list[bytes]:
    """A word in the parts that the network reads and is trained on."""
    return [word[at : at + STEPS] for at in range(0, len(word), STEPS)]


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Two gated recurrent layers, one per direction, and a linear output.

    ``inputs[d]`` holds a row per byte: the byte's part of the update, reset and
    candidate gates. ``states[d]`` is the same for the previous state.
    """

    languages: list[str]
    inputs: list[np.ndarray] = field(default_factory=list)
    states: list[np.ndarray] = field(default_factory=list)
    bias: list[np.ndarray] = field(default_factory=list)
    output: np.ndarray | None = None
    shift: np.ndarray | None = None

    @classmethod
    def fresh(cls, languages: list[str], hidden: int = HIDDEN, seed: int = 7) -> Network:
        draw = np.random.default_rng(seed)
        scale = 1 / np.sqrt(hidden)
        net = cls(languages)
        for _ in range(2):
            net.inputs.append((draw.normal(size=(256, 3 * hidden)) * 0.3).astype(np.float32))
            net.states.append((draw.normal(size=(hidden, 3 * hidden)) * scale).astype(np.float32))
            net.bias.append(np.zeros(hidden, dtype=np.float32))
        net.output = (draw.normal(size=(2 * hidden, len(languages))) * scale).astype(np.float32)
        net.shift = np.zeros(len(languages), dtype=np.float32)
        return net

    def weights(self) -> list[np.ndarray]:
        return [*self.inputs, *self.states, *self.bias, self.output, self.shift]

    def _read(self, side: int, data: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States after each step: step, word, unit."""
        hidden = self.states[side].shape[0]
        state = np.zeros((data.shape[0], hidden), dtype=np.float32)
        out = np.empty((data.shape[1], *state.shape), dtype=np.float32)
        for step in range(data.shape[1]):
            given, carried = self.inputs[side][data[:, step]], state @ self.states[side]
            gates = _sigmoid(given[:, : 2 * hidden] + carried[:, : 2 * hidden])
            update, reset = gates[:, :hidden], gates[:, hidden:]
            inner = carried[:, 2 * hidden :] + self.bias[side]
            fresh = np.tanh(given[:, 2 * hidden :] + reset * inner)
            if keep is not None:
                keep.append((state, update, reset, inner, fresh))
            state = fresh + update * (state - fresh)
            out[step] = state
        return out

    def _unread(self, side: int, data: np.ndarray, kept: list, slope: np.ndarray):
        """Gradients of one direction, from the last step back to the first."""
        hidden = self.states[side].shape[0]
        inputs, states = np.zeros_like(self.inputs[side]), np.zeros_like(self.states[side])
        bias = np.zeros_like(self.bias[side])
        back = np.zeros_like(slope[0])
        for step in range(data.shape[1] - 1, -1, -1):
            state, update, reset, inner, fresh = kept[step]
            back = back + slope[step]
            d_fresh = back * (1 - update) * (1 - fresh**2)
            d_inner = d_fresh * reset
            d_update = back * (state - fresh) * update * (1 - update)
            d_reset = d_fresh * inner * reset * (1 - reset)
            d_carried = np.concatenate([d_update, d_reset, d_inner], axis=1)
            np.add.at(inputs, data[:, step], np.concatenate([d_update, d_reset, d_fresh], axis=1))
            states += state.T @ d_carried
            bias += d_inner.sum(axis=0)
            back = back * update + d_carried @ self.states[side].T
        return inputs, states, bias

    def label(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Sum over the positions of each word of the languages' probabilities, and
        the number of positions."""
        data, sizes = _matrix(words)
        probability = _softmax(self._outputs(data, sizes))
        inside = np.arange(data.shape[1])[:, None] < sizes
        return np.einsum("twl,tw->wl", probability, inside.astype(np.float32)), sizes

    def _outputs(self, data, sizes, keep: list | None = None) -> np.ndarray:
        kept: list[list] = [[], []]
        ahead = self._read(0, data, kept[0] if keep is not None else None)
        mirrored = _mirror(data.T, sizes).T
        behind = _mirror(self._read(1, mirrored, kept[1] if keep is not None else None), sizes)
        both = np.concatenate([ahead, behind], axis=2)
        if keep is not None:
            keep += [kept, mirrored, both]
        return both @ self.output + self.shift

    def learn(self, words: list[bytes], target: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross-entropy over all positions of some words."""
        data, sizes = _matrix(words)
        keep: list = []
        probability = _softmax(self._outputs(data, sizes, keep))
        kept, mirrored, both = keep
        inside = (np.arange(data.shape[1])[:, None] < sizes).astype(np.float32)
        slope = probability
        slope[:, np.arange(len(words)), target] -= 1
        slope *= (inside / inside.sum())[:, :, None]
        hidden = self.bias[0].shape[0]
        d_output = np.einsum("twh,twl->hl", both, slope)
        d_both = slope @ self.output.T
        first = self._unread(0, data, kept[0], d_both[:, :, :hidden])
        second = self._unread(1, mirrored, kept[1], _mirror(d_both[:, :, hidden:], sizes))
        return [first[0], second[0], first[1], second[1], first[2], second[2], d_output, slope.sum(axis=(0, 1))]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _matrix(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words of at most ``STEPS`` bytes as rows, padded with zeros behind."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    width = int(sizes.max())
    data = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8)
    return data.reshape(len(words), width), sizes


def _mirror(steps: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Reverse the first ``sizes`` steps of each word (axes: step, word, ...)."""
    at = np.arange(steps.shape[0])[:, None]
    return steps[np.where(at < sizes, sizes - 1 - at, at), np.arange(steps.shape[1])]


def train(samples: dict[str, list[bytes]], rounds: int = 5, batch: int = 256, seed: int = 7) -> Network:
    """Fit the network on words per language; each language counts alike."""
    languages = sorted(samples)
    net = Network.fresh(languages, seed=seed)
    words = [(w, i) for i, name in enumerate(languages) for w in samples[name]]
    draw = np.random.default_rng(seed)
    weights = net.weights()
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    count = 0
    for _ in range(rounds if len(languages) > 1 else 0):
        order = draw.permutation(len(words))
        # Words of similar length share a batch, the batches come in random order.
        order = order[np.argsort([len(words[i][0]) for i in order], kind="stable")]
        groups = [order[at : at + batch] for at in range(0, len(order), batch)]
        for number in draw.permutation(len(groups)):
            some = [words[i] for i in groups[number]]
            slopes = net.learn([w for w, _ in some], np.array([i for _, i in some]))
            count += 1
            for w, m, v, g in zip(weights, first, second, slopes):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 0.01 * (m / (1 - 0.9**count)) / (np.sqrt(v / (1 - 0.999**count)) + 1e-8)
    return net


class Labeller:
    """A network with the words it has met in this process."""

    def __init__(self, net: Network):
        self.net = net
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.bytes = 0
        self.sums = np.zeros((1, len(self.net.languages)), dtype=np.float32)
        self.sizes = np.zeros(1, dtype=np.int64)

    def _meet(self, words: list[bytes]) -> None:
        parts = [(i, part) for i, w in enumerate(words) for part in parts_of(w)]
        parts.sort(key=lambda part: len(part[1]))
        sums = np.zeros((len(words), self.sums.shape[1]), dtype=np.float32)
        sizes = np.zeros(len(words), dtype=np.int64)
        for at in range(0, len(parts), 4096):
            some = parts[at : at + 4096]
            owner = np.array([i for i, _ in some])
            found, length = self.net.label([w for _, w in some])
            np.add.at(sums, owner, found)
            np.add.at(sizes, owner, length)
        for word in words:
            self.known[word] = len(self.known) + 1
            self.bytes += len(word)
        self.sums = np.concatenate([self.sums, sums])
        self.sizes = np.concatenate([self.sizes, sizes])

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if not self.net.languages:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        if len(self.known) > MEMORY or self.bytes > MEMORY_BYTES:
            self._forget()
        split = [words_of(text) for text in texts]
        new = list(dict.fromkeys(w for words in split for w in words if w not in self.known))
        if new:
            self._meet(new)
        names, scores = [], []
        for text, words in zip(texts, split):
            if not words or not has_letter(text):
                names.append(UNDETERMINED)
                scores.append(0.0)
                continue
            places = list(map(self.known.__getitem__, words))
            mean = self.sums[places].sum(axis=0, dtype=np.float64) / self.sizes[places].sum()
            best = int(mean.argmax())
            names.append(self.net.languages[best])
            scores.append(min(1.0, float(mean[best])))
        return names, scores


def held_out(id_col: str = "doc_id"):
    """Whether a document is kept from training: crc32 of its id as text mod 3 is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_language(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
    sample_words: int = SAMPLE_WORDS,
) -> Network:
    """Train on documents that are not held out and have a language: per language
    the ``sample_docs`` with the smallest text hash, and of their words, long ones in
    parts, ``sample_words`` drawn by frequency."""
    usable = docs.filter(~held_out(id_col)).filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    slim = usable.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("key"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("key"))
    rows = slim.withColumn("rank", rank).filter(F.col("rank") <= sample_docs).select("lang", "text").collect()
    found: dict[str, Counter] = {}
    for row in rows:
        found.setdefault(row["lang"], Counter()).update(p for w in words_of(row["text"]) for p in parts_of(w))
    draw = np.random.default_rng(11)
    samples = {}
    for name, counts in sorted(found.items()):
        if counts:
            words = sorted(counts)
            odds = np.sqrt([counts[w] for w in words])
            samples[name] = [words[i] for i in draw.choice(len(words), sample_words, p=odds / odds.sum())]
    return train(samples)


_LABELLERS: dict[bytes, Labeller] = {}


def _labeller(net: Network) -> Labeller:
    key = net.output.tobytes() + net.shift.tobytes()
    if key not in _LABELLERS:
        _LABELLERS.clear()
        _LABELLERS[key] = Labeller(net)
    return _LABELLERS[key]


def predict_language(
    docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one row per input row.

    Only the text is an input of the prediction. A text that is null or has no
    letter is ``und`` with score 0, as is every text when there was nothing to learn
    from. With a single language every text with letters gets it. A null id is not
    held out; repeated rows are predicted alike; other columns are not read.
    """

    def predict(batch: pa.RecordBatch):
        names, scores = _labeller(net).predict(batch.column(1).to_pylist())
        columns = [batch.column(0), batch.column(2), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(id_col, text_col, held_out(id_col).alias("held_out"))
    return map_batches(rows, predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
