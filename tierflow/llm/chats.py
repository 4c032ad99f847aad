"""Chat formatting that is proved by reading it back.

A conversation is rendered with control strings around its turns. Each turn is
parsed again by the grammar below; where the parser does not return the very turn
that went in, the text holds something that reads as a control string, and the turn
is rendered once more with those places escaped, until it comes back identical.

    chat      = "<s>" turn*
    turn      = "[INST]" body "[/INST]"             of a user
              | "[SYS]" body "[/SYS]"               of the system
              | "[ROLE " role "]" body "[/ROLE]"    of any other role
              | body "</s>"                         of the assistant
    body      = " " text " "

A backslash takes the next character literally. No control string holds the first
character of another, so places to escape never overlap.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import find_package

# The control strings of the template.
BEGIN = "<s>"
MARKS = {"user": ("[INST]", "[/INST]"), "system": ("[SYS]", "[/SYS]"), "assistant": ("", "</s>")}
OTHER = ("[ROLE ", "]", "[/ROLE]")

#: What text may not hold as it is, or the parser would act on it.
CONTROL = re.compile(r"\\|</?s>|\[/?INST\]|\[/?SYS\]|\[ROLE |\[/ROLE\]")
#: The name of a role goes up to the bracket that ends it.
CONTROL_ROLE = re.compile(r"\\|\]")
ESCAPED = re.compile(r"\\(.)", re.S)

#: Code points after which a formatted conversation goes on in a further row.
PART = 1 << 20


class NotChat(ValueError):
    """Text that the grammar does not allow."""


def escape(text: str, control: re.Pattern = CONTROL) -> str:
    return control.sub(lambda found: "\\" + found.group(), text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def _until(text: str, at: int, end: str, control: re.Pattern = CONTROL) -> tuple[str, int]:
    """The literal text from ``at`` up to the control string ``end``, and the place
    after it. Any other control string there is an error."""
    parts, begin = [], at
    while True:
        found = control.search(text, at)
        if found is None:
            raise NotChat(f"{end} is missing")
        if found.group() == "\\":
            if found.end() == len(text):
                raise NotChat("nothing after a backslash")
            parts.append(text[begin : found.start()])
            begin, at = found.end(), found.end() + 1
        elif found.group() == end:
            parts.append(text[begin : found.start()])
            return "".join(parts), found.end()
        else:
            raise NotChat(f"{found.group()} before {end}")


def parse_turn(text: str, at: int) -> tuple[str, str, int, int, int]:
    """(role, text, begin, end, after) of the turn at a place: what it says, where its
    text stands in the formatted one, and where the next turn begins."""
    for role, (opening, closing) in MARKS.items():
        if opening and text.startswith(opening, at):
            at += len(opening)
            break
    else:
        role, closing = "assistant", MARKS["assistant"][1]
        if text.startswith(OTHER[0], at):
            role, at = _until(text, at + len(OTHER[0]), OTHER[1], CONTROL_ROLE)
            closing = OTHER[2]
    said, after = _until(text, at, closing)
    end = after - len(closing)
    if end - at < 2 or text[at] != " " or not said.endswith(" "):
        raise NotChat("a text stands between two blanks")
    return role, said[1:-1], at + 1, end - 1, after


def parse_chat(text: str) -> list[tuple[str, str, int, int]]:
    """(role, text, begin, end) of all turns of a formatted conversation."""
    if not text.startswith(BEGIN):
        raise NotChat(f"{BEGIN} is missing")
    turns, at = [], len(BEGIN)
    while at < len(text):
        *turn, at = parse_turn(text, at)
        turns.append(tuple(turn))
    return turns


def _render(role: str, text: str, level: int) -> tuple[str, int]:
    """A formatted turn and where its text begins. Level 0 escapes nothing, 1 the text,
    2 the role too."""
    body = escape(text) if level else text
    if role in MARKS:
        opening, closing = MARKS[role]
    else:
        named = escape(role, CONTROL_ROLE) if level > 1 else role
        opening, closing = OTHER[0] + named + OTHER[1], OTHER[2]
    return f"{opening} {body} {closing}", len(opening) + 1


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn as formatted text, and where in it the text begins and ends.

    Escapes only what the parser would otherwise take for control strings: each try
    is parsed and compared with the turn.
    """
    for level in range(3):
        shown, begin = _render(role, text, level)
        try:
            back = parse_turn(shown, 0)
        except NotChat:
            continue
        if back[:2] == (role, text) and back[4] == len(shown):
            return shown, back[2], back[3]
    raise AssertionError(f"no form of the turn can be read back: {role!r}")


FORMATTED = "conv_id long, part int, formatted string, spans array<struct<begin:long,end:long>>"


def format_chats(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv_id, part, formatted, spans): each conversation as one formatted text and
    the spans of it under the loss mask, the assistant's texts, in code points from the
    beginning of the conversation.

    Rows go by turn; equal turns by role, then text; a null turn comes last. Repeated
    rows are turns of their own. A null text or role is empty, rows with a null id are
    one conversation. A conversation longer than ``PART`` code points goes on in rows
    of the next ``part``, cut between turns, so a task holds one part of it at a time.
    Parts of a conversation follow each other in one partition. Other columns are not
    read. An empty table gives no rows.
    """
    find_package(turns.sparkSession)
    most = PART

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chat = None
        out: list[tuple] = []
        for batch in batches:
            for key, role, text in zip(*(batch.column(c).to_pylist() for c in ("key", "role", "text"))):
                if chat is None or chat.key != key:
                    out += chat.flush() if chat else []
                    chat = _Chat(key, most)
                out += chat.add(role, text)
            if out:
                yield _rows(out)
                out = []
        if chat is not None:
            yield _rows(chat.flush())

    rows = turns.select(
        F.col(id_col).cast("long").alias("key"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    order = ["key", F.col("turn").asc_nulls_last(), "role", "text"]
    return rows.repartition("key").sortWithinPartitions(*order).mapInArrow(run, FORMATTED)


class _Chat:
    """A conversation in the making."""

    def __init__(self, key: int | None, most: int):
        self.key, self.most, self.part, self.before = key, most, 0, 0
        self.shown, self.spans, self.length = [BEGIN], [], len(BEGIN)

    def add(self, role: str, text: str) -> list[tuple]:
        shown, begin, end = format_turn(role, text)
        full = self.flush() if self.length and self.length + len(shown) > self.most else []
        at = self.before + self.length
        if role == "assistant":
            self.spans.append({"begin": at + begin, "end": at + end})
        self.shown.append(shown)
        self.length += len(shown)
        return full

    def flush(self) -> list[tuple]:
        row = (self.key, self.part, "".join(self.shown), self.spans)
        self.before, self.part = self.before + self.length, self.part + 1
        self.shown, self.spans, self.length = [], [], 0
        return [row]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.string(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))]
    names = ["conv_id", "part", "formatted", "spans"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def read_chats(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars): what
    the rows of :func:`format_chats` say, read from the formatted text and its spans only.

    Hashes run over the parts of a conversation one after another. A text that the
    grammar does not allow is an error.
    """
    find_package(formatted.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if row["part"] == 0:
                    done += [seen.row()] if seen else []
                    seen = _Reader(row["conv_id"])
                seen.read(row["formatted"], row["spans"])
            if done:
                yield _digests(done)
        if seen is not None:
            yield _digests([seen.row()])

    # The rows of a conversation lie together already: nothing is shuffled again.
    return formatted.mapInArrow(run, DIGESTS)


class _Reader:
    def __init__(self, key: int | None):
        self.key, self.turns, self.before, self.loss = key, 0, 0, 0
        self.said, self.masked = hashlib.sha256(), hashlib.sha256()

    def read(self, text: str, spans: list[dict]) -> None:
        for role, said, _, _ in parse_chat(text if self.before == 0 else BEGIN + text):
            self.turns += 1
            self.said.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
        for span in spans:
            masked = unescape(text[span["begin"] - self.before : span["end"] - self.before])
            self.loss += len(masked)
            self.masked.update(masked.encode("utf-8", "surrogatepass"))
        self.before += len(text)

    def row(self) -> tuple:
        return self.key, self.turns, self.said.hexdigest(), self.loss, self.masked.hexdigest(), self.before


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
