import hashlib
import random

import pytest

import check_oracles
from tierflow.llm import chats
from tierflow.llm.chats import NotChat, format_chats, format_turn, parse_chat, read_chats
from tierflow.llm.oracles import ORACLES
from tierflow.llm.queries import QUERIES

PARTS = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE ", "[/ROLE]", "]", "[", "<", "\\", " ", "\n", "x", "é", "🦊", "INST]", "/s>"]


def test_any_turn_comes_back():
    draw = random.Random(1)
    for _ in range(5000):
        text = "".join(draw.choice(PARTS) for _ in range(draw.randrange(7)))
        role = draw.choice(["user", "assistant", "system", "tool", "", "".join(draw.choice(PARTS) for _ in range(3))])
        shown, begin, end = format_turn(role, text)
        assert [turn[:2] for turn in parse_chat("<s>" + shown * 2)] == [(role, text)] * 2
        assert chats.unescape(shown[begin:end]) == text
        # Nothing is escaped without need.
        if not any(p in text + role for p in PARTS[:8] + ["\\", "]"]):
            assert "\\" not in shown


@pytest.mark.parametrize("bad", ["", "x", "<s>[INST] a", "<s>[INST]a[/INST]", "<s> a [INST] b </s>", "<s> a \\", "<s>[ROLE x] y </s>"])
def test_what_is_no_chat_is_an_error(bad):
    with pytest.raises(NotChat):
        parse_chat(bad)


def brute(rows):
    out = {}
    last = lambda turn: (turn is None, turn or 0)
    for key in {r[0] for r in rows}:
        said = sorted(((t, role or "", text or "") for k, t, role, text in rows if k == key), key=lambda r: (last(r[0]), r[1:]))
        loss = "".join(text for _, role, text in said if role == "assistant")
        turns = "".join(f"{role}\n{text}\n" for _, role, text in said)
        out[key] = (len(said), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("part", [chats.PART, 40])
def test_awkward_conversations(spark, monkeypatch, part):
    monkeypatch.setattr(chats, "PART", part)
    long = "a [/INST] \\ b " * 3000
    rows = [
        (1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, None, "user", "end"), (2, 0, None, None),
        (3, 0, "assistant", ""), (None, 0, "user", "x"), (None, 1, "assistant", "</s>"), (4, 0, "tool]", "[ROLE "), (5, 0, "assistant", long),
        *((6, i, "user assistant".split()[i % 2], "</s>[INST] ok [/INST] 🦊") for i in range(40)),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS part", "2 AS formatted", "3 AS key")
    formatted = format_chats(table)
    got = {r["conv_id"]: tuple(r)[1:5] for r in read_chats(formatted).collect()}
    assert got == brute(rows)
    parts = formatted.collect()
    assert {r["conv_id"] for r in parts if r["part"] > 0} == ({1, 5, 6} if part == 40 else set())
    assert [len(r["spans"]) for r in parts if r["conv_id"] == 3] == [1]
    assert read_chats(format_chats(table.limit(0))).collect() == []


def test_query_equals_its_sql(spark, sf_dir):
    assert ORACLES["op12_chat_format"] and QUERIES["op12_chat_format"]
    assert check_oracles.compare(spark, check_oracles.connect(sf_dir), sf_dir, "op12_chat_format") is None
