"""Secret scan: all rules in one pass of a combined deterministic automaton."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tierflow.llm.automaton import Automaton, compile_rules
from tierflow.llm.common import map_batches


@dataclass(frozen=True)
class Rule:
    """A pattern that ends in a run of one class, taken as far as it goes.

    A match counts if the run has ``run`` bytes or more, counted from the first
    byte with which the pattern is complete. Shorter matches are dropped, but
    still use up their bytes.
    """

    kind: str
    pattern: str
    run: int = 1
    either_case: bool = False


# The three base rules.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
        12,
        True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 14),
    # 16 characters: 4 in the pattern, which keeps the automaton small, and a run.
    Rule("hex", r"[0-9a-f]{4,}", 13),
)
#: Rules of this operator beside the base: well-known key formats.
EXTRA = (
    Rule("hosting", r"gh[opsur]_[A-Za-z0-9]+", 36),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", 10),
    Rule("payment", r"[rs]k_live_[A-Za-z0-9]+", 24),
    Rule("webtoken", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+", 10),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-+", 5),
)


class Scanner:
    """The compiled rules. Each byte of a text is read once; only where the pattern
    of a rule is complete does a reversed automaton look for its start."""

    #: With fewer texts still running than this, the rest is read one by one.
    LANES = 24

    def __init__(self, rules: Sequence[Rule]):
        self.rules = tuple(rules)
        patterns = [(rule.pattern, rule.either_case) for rule in self.rules]
        self.forward = compile_rules(patterns)
        # Where no match goes on, one that is complete has the shortest run there is.
        self.backward = [
            compile_rules([(_shortest(p), either)], anywhere=False, backwards=True) for p, either in patterns
        ]
        self.table = np.array(self.forward.table, dtype=np.int32)
        self.resets = np.isin(np.arange(256), list(self.forward.resets))

    def find(self, texts: Sequence[str | None]) -> list[list[tuple[int, int, int]]]:
        """For each text the (start, end, rule) of all matches in code points, by
        start, then rule; leftmost and without overlaps within each rule."""
        encoded = [(text or "").encode("utf-8", "surrogatepass") for text in texts]
        # No UTF-8 text holds 0xff, so it ends every pattern between two texts.
        joined = np.frombuffer(b"\xff".join([*encoded, b""]), dtype=np.uint8)
        at, states = self._complete(joined)
        begins = np.cumsum([0, *(len(data) + 1 for data in encoded)])
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        owner = np.searchsorted(begins, at, side="right") - 1
        for number in np.unique(owner):
            mine = owner == number
            ends = (at[mine] - begins[number] + 1).tolist()
            data, text = encoded[number], texts[number]
            spans = self._spans(data, list(zip(ends, states[mine].tolist())))
            if len(data) != len(text):
                points = np.cumsum(np.frombuffer(b"\x80" + data, dtype=np.uint8) & 0xC0 != 0x80)
                # The byte put in front makes it the characters before each byte and at the end.
                spans = [(int(points[a]), int(points[b]), rule) for a, b, rule in spans]
            found[number] = sorted(spans, key=lambda span: (span[0], span[2]))
        return found

    def _complete(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places where some rule's pattern is complete, and the states there.

        Bytes that reset the automaton cut the data into pieces that start alike.
        All pieces advance together, one byte a step, the longest first.
        """
        cuts = np.flatnonzero(self.resets[data])
        begins = np.concatenate([[0], cuts + 1])
        lengths = np.concatenate([cuts, [len(data)]]) - begins
        order = np.argsort(-lengths, kind="stable")
        begins, lengths = begins[order], lengths[order]
        state = np.full(len(begins), self.forward.start, dtype=np.int32)
        running = np.searchsorted(-lengths, -np.arange(lengths[0] + 1), side="left")
        accepting, places, states = self.forward.accepting, [], []
        for step in range(int(lengths[0])):
            n = int(running[step])
            if n < self.LANES:
                self._one_by_one(data, begins[:n] + step, lengths[:n] - step, state[:n], places, states)
                break
            where = begins[:n] + step
            state = self.table[state[:n] + data[where]]
            hits = np.flatnonzero(state >= accepting)
            if len(hits):
                places.append(where[hits])
                states.append(state[hits])
        if not places:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)
        at, states = np.concatenate(places), np.concatenate(states)
        order = np.argsort(at, kind="stable")
        return at[order], states[order]

    def _one_by_one(self, data, begins, lengths, current, places, states) -> None:
        table, accepting = self.forward.table, self.forward.accepting
        for begin, length, state in zip(begins.tolist(), lengths.tolist(), current.tolist()):
            hits, reached = [], []
            for at, byte in enumerate(data[begin : begin + length].tobytes(), begin):
                state = table[state + byte]
                if state >= accepting:
                    hits.append(at)
                    reached.append(state)
            places.append(np.array(hits, dtype=np.int64))
            states.append(np.array(reached, dtype=np.int32))

    def _spans(self, data: bytes, complete: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        spans = []
        for number, rule in enumerate(self.rules):
            bit = 1 << number
            ends = [end for end, state in complete if self.forward.rules[state >> 8] & bit]
            start = first = last = -1
            used = 0
            for end in ends:
                if start >= 0 and end == last + 1:
                    last = end
                    continue
                if start >= 0:
                    used = last
                    if last - first + 1 >= rule.run:
                        spans.append((start, last, number))
                start = _leftmost(self.backward[number], data, end, used)
                first = last = end
            if start >= 0 and last - first + 1 >= rule.run:
                spans.append((start, last, number))
        return spans


def _leftmost(automaton: Automaton, data: bytes, end: int, least: int) -> int:
    """The smallest start from ``least`` on of a match that ends at ``end``, or -1."""
    state, start = automaton.start, -1
    for at in range(end - 1, least - 1, -1):
        state = automaton.table[state + data[at]]
        if state >= automaton.accepting:
            start = at
        elif state == automaton.dead:
            break
    return start


def _shortest(pattern: str) -> str:
    """The pattern with the run that it ends in as short as may be."""
    if pattern.endswith("+"):
        return pattern[:-1]
    if pattern.endswith(",}"):
        return pattern[:-2] + "}"
    raise ValueError(f"pattern does not end in a run: {pattern}")


_COMPILED: dict[tuple[Rule, ...], Scanner] = {}


def scanner(rules: Sequence[Rule]) -> Scanner:
    """The rules compiled once per Python process."""
    key = tuple(rules)
    if key not in _COMPILED:
        _COMPILED[key] = Scanner(key)
    return _COMPILED[key]


def joined(spans, rules: Sequence[Rule]) -> str:
    return ",".join(f"{rules[rule].kind}:{start}:{end}" for start, end, rule in spans)


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", extra: Sequence[Rule] = EXTRA
) -> DataFrame:
    """Secrets of each whole text: counts and spans, one row per input row.

    A null text is empty and has no spans; a null id stays null; repeated rows
    stay repeated. Other columns are not read, whatever their names. An empty
    table gives no rows. Base matches are the same with and without ``extra``.
    """
    rules = (*BASE, *extra)

    def scan(batch: pa.RecordBatch):
        out: list[list] = [[], [], [], [], []]
        for spans in scanner(rules).find(batch.column(1).to_pylist()):
            base = [span for span in spans if span[2] < len(BASE)]
            for number in range(len(BASE)):
                out[number].append(sum(span[2] == number for span in base))
            out[3].append(hashlib.sha256(joined(base, rules).encode()).hexdigest())
            out[4].append(joined(spans, rules))
        columns = [batch.column(0), *map(pa.array, out[:3], [pa.int64()] * 3), *map(pa.array, out[3:], [pa.string()] * 2)]
        yield pa.RecordBatch.from_arrays(
            columns, names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
        )

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(
        docs.select(id_col, text_col),
        scan,
        f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
    )


def redact_secrets(
    docs: DataFrame, text_col: str = "text", extra: Sequence[Rule] = EXTRA, mark: str = "[secret]"
) -> DataFrame:
    """The same rows and columns with every secret in the text replaced by ``mark``.

    Spans that overlap are replaced together. Null texts stay null.
    """
    rules = (*BASE, *extra)

    def clean(text: str | None, spans) -> str | None:
        if not spans:
            return text
        parts, at = [], 0
        for start, end, _ in spans:
            if start >= at:
                parts += [text[at:start], mark]
            at = max(at, end)
        return "".join([*parts, text[at:]])

    place = docs.columns.index(text_col)

    def redact(batch: pa.RecordBatch):
        texts = batch.column(place).to_pylist()
        texts = list(map(clean, texts, scanner(rules).find(texts)))
        columns = list(batch.columns)
        columns[place] = pa.array(texts, pa.string())
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return map_batches(docs, redact, docs.schema)
