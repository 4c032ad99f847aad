"""SentencePiece encoding and decoding by suffix-array matching.

The new words of a batch are joined into one text and its suffixes are sorted. A
binary search per piece gives the range of suffixes that start with it, hence all
its occurrences. These are the edges of a lattice; sorted by position they are
relaxed once, each place keeping the one last piece that byte-pair encoding gives
the text up to there.

Why one pass is enough: the pieces of an encoded text, cut anywhere between two
pieces, are the encodings of both parts, and a sequence of pieces is the encoding
of its text if and only if each neighbouring pair is the encoding of the pair's own
text. So an edge may follow the last piece before it exactly if the pair encodes to
itself, and each place has one such edge.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tierflow.llm.common import map_batches

#: The tokenizer that the queries use; any byte-fallback BPE model works.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"

SPACE = "▁"
#: A run of spaces with the characters behind it. No piece holds a space after
#: another character, so no piece crosses from one word to the next.
WORDS = re.compile(" *[^ ]+| +")
#: Words, and characters of words, remembered per Python process before the memory is
#: emptied. A word of a script without spaces may be a whole text.
MEMORY, LETTERS = 800_000, 1 << 24


@dataclass(frozen=True)
class Pieces:
    """The part of a model that encoding needs, small enough for a closure."""

    text: list[str]
    score: list[float]
    ids: list[int]
    #: Ids of the single bytes, and the bytes each id stands for.
    byte_ids: list[int]
    spelled: list[bytes]
    dummy_prefix: bool = True


def load_pieces(path: str = MODEL) -> Pieces:
    """Read a model file on the driver. Its pieces travel inside the closures, so
    executors need no file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    text, score, ids, spelled = [], [], [], []
    byte_ids = [-1] * 256
    for number in range(model.get_piece_size()):
        piece = model.id_to_piece(number)
        if model.is_byte(number):
            byte_ids[int(piece[3:-1], 16)] = number
            spelled.append(bytes([int(piece[3:-1], 16)]))
        elif model.is_control(number) or model.is_unknown(number) or model.is_unused(number):
            spelled.append(b"")
        else:
            text.append(piece)
            score.append(model.get_score(number))
            ids.append(number)
            spelled.append(piece.replace(SPACE, " ").encode())
    if -1 in byte_ids or any(SPACE in piece.lstrip(SPACE) for piece in text):
        raise ValueError("the model needs byte fallback and pieces with spaces in front only")
    return Pieces(text, score, ids, byte_ids, spelled)


def merge(chars: str, scores: dict[str, float]) -> list[str]:
    """Plain byte-pair encoding: join the best-scored neighbours, leftmost first."""
    parts = list(chars)
    while True:
        best, at = -np.inf, -1
        for i in range(len(parts) - 1):
            score = scores.get(parts[i] + parts[i + 1])
            if score is not None and score > best:
                best, at = score, i
        if at < 0:
            return parts
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


class Known(dict):
    """Numbers of words by first sight; ``fresh`` are those not encoded yet."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self.fresh.append(word)
        number = self[word] = len(self)
        return number


@dataclass
class Encoder:
    pieces: Pieces
    scores: dict[str, float] = field(init=False)
    known: Known = field(default_factory=Known, init=False)

    START, NOTHING = -1, -2

    def __post_init__(self):
        self.scores = dict(zip(self.pieces.text, self.pieces.score))
        # Pieces that encoding never yields, even alone, take no part.
        usable = [
            (t, i)
            for t, i in zip(self.pieces.text, self.pieces.ids)
            if len(t) == 1 or merge(t, self.scores) == [t]
        ]
        self.texts = [t for t, _ in usable]
        self.piece_ids = np.array([i for _, i in usable], dtype=np.int32)
        self.size = len(usable)
        self.lengths = np.array([len(t) for t in self.texts] or [0], dtype=np.int64)
        self.longest = int(self.lengths.max())
        self.codes = np.zeros((self.size, self.longest), dtype=np.uint32)
        for row, t in enumerate(self.texts):
            self.codes[row, : len(t)] = [ord(c) for c in t]
        self.single = {ord(t): i for i, t in enumerate(self.texts) if len(t) == 1}
        # Verdicts on pairs of pieces seen so far, as sorted keys.
        self.pairs, self.fits = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
        self._forget()

    def _forget(self) -> None:
        self.known, self.letters = Known(), 0
        self.flat = np.zeros(0, dtype=np.int32)
        self.begin, self.count = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.whole = np.zeros(0, dtype=bool)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in a row, the offsets between texts, and whether the ids of
        each text spell it: those of each of its words do, which is found out once."""
        if len(self.known) > MEMORY or self.letters > LETTERS:
            self._forget()
        split = []
        for text in texts:
            text = (text or "").replace(SPACE, " ")
            split.append(WORDS.findall(" " + text if text and self.pieces.dummy_prefix else text))
        index = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), dtype=np.int64)
        if self.known.fresh:
            self._learn(self.known.fresh)
            self.known.fresh = []
        sizes = self.count[index]
        total = np.concatenate([[0], np.cumsum(sizes)])
        spread = np.repeat(self.begin[index] - total[:-1], sizes) + np.arange(total[-1])
        cuts = np.cumsum([0, *map(len, split)])
        broken = np.concatenate([[0], np.cumsum(~self.whole[index])])[cuts]
        marked = np.array([SPACE in (text or "") for text in texts], dtype=bool)
        return self.flat[spread], total[cuts], (np.diff(broken) == 0) & ~marked

    def _learn(self, words: list[str]) -> None:
        """Encode new words together and remember their ids."""
        ids, sizes = self._segment(words)
        ends = np.cumsum(sizes)
        begin = len(self.flat) + ends - sizes
        spelled, plain, cuts = self.pieces.spelled, ids.tolist(), [0, *ends.tolist()]
        whole = [
            b"".join([spelled[i] for i in plain[a:b]]) == word.encode("utf-8", "replace")
            for word, a, b in zip(words, cuts, cuts[1:])
        ]
        self.whole = np.concatenate([self.whole, whole]).astype(bool)
        self.letters += sum(map(len, words))
        self.flat = np.concatenate([self.flat, ids])
        self.begin = np.concatenate([self.begin, begin])
        self.count = np.concatenate([self.count, sizes])

    def _segment(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = "\0".join(words).replace(" ", SPACE)
        chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        starts = np.cumsum(sizes + 1) - sizes - 1
        begin, piece = self._edges(chars, starts, sizes)
        last = self._relax(len(chars), begin, piece, starts, sizes)
        return self._trace(chars, last, starts, sizes)

    def _edges(self, chars: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        """(start, piece) of every occurrence of a piece, by its suffix range. A
        character without a piece is an edge of its own, numbered from ``size`` on."""
        n, longest = len(chars), self.longest
        order = suffix_order(chars, longest)
        padded = np.concatenate([chars, np.zeros(longest, dtype=np.uint32)])
        low = np.zeros(self.size, dtype=np.int64)
        high = np.full(self.size, n, dtype=np.int64)
        alive = np.arange(self.size)
        for depth in range(longest):
            alive = alive[(self.lengths[alive] > depth) & (low[alive] < high[alive])]
            if not len(alive):
                break
            at = padded[order + depth] if depth == 0 else None
            wanted = self.codes[alive, depth]
            if at is not None:
                low[alive], high[alive] = np.searchsorted(at, wanted, "left"), np.searchsorted(at, wanted, "right")
                continue
            left = _bound(padded, order, low[alive], high[alive], wanted, depth, False)
            right = _bound(padded, order, left, high[alive], wanted, depth, True)
            low[alive], high[alive] = left, right
        found = np.maximum(high - low, 0)
        piece = np.repeat(np.arange(self.size), found)
        total = np.cumsum(found)
        begin = order[np.repeat(low - (total - found), found) + np.arange(total[-1] if len(total) else 0)]
        # Characters that no single piece covers.
        lone = np.ones(n, dtype=bool)
        lone[begin[self.lengths[piece] == 1]] = False
        lone[(starts + sizes)[:-1]] = False
        extra = np.flatnonzero(lone)
        return np.concatenate([begin, extra]), np.concatenate([piece, self.size + chars[extra].astype(np.int64)])

    def _relax(self, n, begin, piece, starts, sizes) -> np.ndarray:
        """The last piece of the encoding up to each place, edges by position."""
        length = np.where(piece < self.size, self.lengths[np.minimum(piece, self.size - 1)], 1)
        end = begin + length
        word = np.repeat(starts, sizes + 1)[:n]
        depth = end - word[begin]
        order = np.argsort(depth, kind="stable")
        begin, piece, end, depth = begin[order], piece[order], end[order], depth[order]
        last = np.full(n + 1, self.NOTHING, dtype=np.int64)
        last[starts] = self.START
        cuts = np.searchsorted(depth, np.arange(1, int(sizes.max()) + 2))
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if low == high:
                continue
            before, after, ends = last[begin[low:high]], piece[low:high], end[low:high]
            good = self._may_follow(before, after)
            last[ends[good]] = after[good]
        return last

    def _may_follow(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Whether each pair encodes to itself. Nothing joins a character without a
        piece, and any piece may come first."""
        good = before != self.NOTHING
        ask = good & (before >= 0) & (before < self.size) & (after < self.size)
        if ask.any():
            keys = before[ask] * self.size + after[ask]
            at = np.searchsorted(self.pairs, keys)
            seen = at < len(self.pairs)
            seen[seen] = self.pairs[at[seen]] == keys[seen]
            if not seen.all():
                fresh = np.unique(keys[~seen])
                fits = [self._fits(*divmod(key, self.size)) for key in fresh.tolist()]
                self.pairs = np.concatenate([self.pairs, fresh])
                order = np.argsort(self.pairs, kind="stable")
                self.pairs, self.fits = self.pairs[order], np.concatenate([self.fits, fits]).astype(bool)[order]
                at = np.searchsorted(self.pairs, keys)
            good[ask] = self.fits[at]
        return good

    def _fits(self, left: int, right: int) -> bool:
        a, b = self.texts[left], self.texts[right]
        return merge(a + b, self.scores) == [a, b]

    def _trace(self, chars, last, starts, sizes) -> tuple[np.ndarray, np.ndarray]:
        """Walk all words back from their ends, one piece a step."""
        place, row = starts + sizes, np.arange(len(starts))
        rows, found = [], []
        while len(row):
            piece = last[place]
            if (piece < 0).any():
                raise AssertionError("a word has no encoding")
            rows.append(row)
            found.append(piece)
            place = place - np.where(piece < self.size, self.lengths[np.minimum(piece, self.size - 1)], 1)
            more = place > starts[row]
            place, row = place[more], row[more]
        step = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        rows, found = np.concatenate(rows), np.concatenate(found)
        order = np.lexsort((-step, rows))
        rows, found = rows[order], found[order]
        if (found < self.size).all():
            return self.piece_ids[found], np.bincount(rows, minlength=len(starts))
        ids, width = [], []
        for piece in found.tolist():
            if piece < self.size:
                some = [self.piece_ids[piece]]
            else:
                some = [self.pieces.byte_ids[b] for b in chr(piece - self.size).encode("utf-8", "surrogatepass")]
            ids += some
            width.append(len(some))
        counts = np.bincount(rows, weights=width, minlength=len(starts)).astype(np.int64)
        return np.array(ids, dtype=np.int32), counts

    def decode(self, ids: list[int]) -> str:
        """The text of some ids, without the space that encoding puts in front."""
        spelled = self.pieces.spelled
        text = b"".join([spelled[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.pieces.dummy_prefix and text.startswith(" ") else text


def suffix_order(chars: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` characters or more, by doubling."""
    rank = np.unique(chars, return_inverse=True)[1].astype(np.int64) + 1
    done = 1
    while done < depth:
        shifted = np.zeros_like(rank)
        shifted[:-done] = rank[done:]
        rank = np.unique(rank * (len(rank) + 2) + shifted, return_inverse=True)[1] + 1
        done *= 2
    return np.argsort(rank, kind="stable")


def _bound(padded, order, low, high, wanted, depth, beyond) -> np.ndarray:
    """Binary search in many ranges of the suffix order at once, by one character."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) >> 1
        value = padded[order[np.minimum(middle, len(order) - 1)] + depth]
        right = open_ & ((value <= wanted) if beyond else (value < wanted))
        low = np.where(right, middle + 1, low)
        high = np.where(open_ & ~right, middle, high)


_ENCODERS: dict[int, Encoder] = {}


def encoder(pieces: Pieces) -> Encoder:
    """One encoder per Python process and model, with the words it has met."""
    key = hash((len(pieces.text), tuple(pieces.text[:64]), tuple(pieces.text[-64:]), pieces.score[-1]))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(pieces)
    return _ENCODERS[key]


def encode_pieces(
    docs: DataFrame, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, token_ids, n_tokens, round_trip), one row per input row.

    ``round_trip`` says whether decoding the ids gives the text back; it is false
    only for texts that hold the space mark U+2581 itself, which decodes to a
    space. A null or empty text has no tokens and round-trips as empty. Repeated
    rows are encoded alike, other columns are not read, an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def encode(batch: pa.RecordBatch):
        tool = encoder(shared.value)
        texts = batch.column(1).to_pylist()
        ids, offsets, back = tool.encode(texts)
        tokens = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
        columns = [batch.column(0), tokens, pa.array(np.diff(offsets), pa.int64()), pa.array(back, pa.bool_())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "token_ids", "n_tokens", "round_trip"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, token_ids array<int>, n_tokens long, round_trip boolean"
    return map_batches(docs.select(id_col, text_col), encode, schema)


def decode_pieces(
    tokens: DataFrame, pieces: Pieces, id_col: str = "doc_id", tokens_col: str = "token_ids"
) -> DataFrame:
    """(doc_id, text) of encoded rows. Null or empty token lists give empty text;
    ids outside the model, and bytes that are no UTF-8, give replacement marks."""
    shared = tokens.sparkSession.sparkContext.broadcast(pieces)

    def decode(batch: pa.RecordBatch):
        tool = encoder(shared.value)
        size = len(tool.pieces.spelled)
        unknown = "�".encode()

        def text(ids):
            inside = [tool.pieces.spelled[i] if i is not None and 0 <= i < size else unknown for i in ids or ()]
            whole = b"".join(inside).decode("utf-8", "replace")
            return whole[1:] if tool.pieces.dummy_prefix and whole.startswith(" ") else whole

        texts = [text(ids) for ids in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = tokens.schema[id_col].dataType.simpleString()
    return map_batches(tokens.select(id_col, tokens_col), decode, f"doc_id {kind}, text string")
