import os
import random

import pytest

from tierflow.llm.common import small_batches
from tierflow.llm.pieces import MODEL, Encoder, decode_pieces, encode_pieces, load_pieces, merge, suffix_order

pytestmark = pytest.mark.skipif(not os.path.exists(MODEL), reason="no tokenizer file")


@pytest.fixture(scope="module")
def pieces():
    return load_pieces()


@pytest.fixture(scope="module")
def library():
    return pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=MODEL)


def test_random_texts_equal_the_library(pieces, library):
    draw = random.Random(3)
    parts = ["the", "ing", "  ", " ", "   ", "\n", "a", "tion", "é", "日本", "🦊", "qu", "\t", "123", "//", "oo", "▁", "́", "</s>", "<0x0A>"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 30))) for _ in range(1500)]
    ids, cuts, _ = Encoder(pieces).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:])] == library.encode(texts)


def test_documents_equal_the_library_and_round_trip(documents, pieces, library):
    small_batches(documents.sparkSession)
    encoded = encode_pieces(documents, pieces)
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    for r in encoded.collect():
        assert r["token_ids"] == library.encode(texts[r["doc_id"]] or "")
        assert r["round_trip"] and r["n_tokens"] == len(r["token_ids"])
    back = {r["doc_id"]: r["text"] for r in decode_pieces(encoded, pieces).collect()}
    assert back == {i: t or "" for i, t in texts.items()}


def test_awkward_rows(odd, pieces):
    rows = encode_pieces(odd, pieces).collect()
    assert len(rows) == odd.count() and all(r["round_trip"] for r in rows)
    assert {r["doc_id"]: r["n_tokens"] for r in rows}[1] == 0
    assert encode_pieces(odd.limit(0), pieces).collect() == []


def test_the_space_mark_does_not_round_trip(docs, pieces):
    assert not encode_pieces(docs((1, "x▁y")), pieces).first()["round_trip"]


def test_decoding_takes_any_ids(spark, pieces):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [10**6, None])], "doc_id long, token_ids array<int>")
    assert [r["text"] for r in decode_pieces(rows, pieces).orderBy("doc_id").collect()] == ["", "", "��"]


def test_memory_is_emptied(pieces, monkeypatch):
    monkeypatch.setattr("tierflow.llm.pieces.MEMORY", 1)
    tool = Encoder(pieces)
    first = tool.encode(["some words here"])[0].tolist()
    tool.encode(["other words"])
    assert tool.encode(["some words here"])[0].tolist() == first


def test_suffix_order():
    import numpy as np

    text = "abracadabra\0abra"
    order = suffix_order(np.array([ord(c) for c in text], dtype=np.uint32), 16)
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_merge_is_leftmost_best_first():
    assert merge("aaa", {"aa": 0.0}) == ["aa", "a"]
    assert merge("abc", {"ab": -2.0, "bc": -1.0}) == ["a", "bc"]


def test_memory_is_bounded_by_letters_and_by_words(pieces):
    tool = Encoder(pieces)
    # Texts of a script without spaces are a word each.
    texts = ["".join(chr(0x4E00 + (i * 37 + j * 11) % 900) for j in range(3000)) for i in range(40)]
    want = [Encoder(pieces).encode([t])[0].tolist() for t in texts[:3]]
    tool.letters = 1 << 24
    tool.encode(texts[:1])
    tool.letters += 1 << 24
    ids, cuts, good = tool.encode(texts)
    # The memory was emptied before these were read, and holds only them.
    assert len(tool.known) == 40 and tool.letters <= 40 * 3001 and good.all()
    assert [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:])][:3] == want


def test_round_trip_is_what_decoding_says(pieces):
    texts = ["", None, "a b", "  two  spaces ", "\u2581 mark", "tab\tand\nline", "\U0001F98A \u65e5\u672c", "x" * 5000]
    tool = Encoder(pieces)
    ids, cuts, good = tool.encode(texts)
    back = [tool.decode(ids[a:b].tolist()) == (t or "") for t, a, b in zip(texts, cuts, cuts[1:])]
    assert good.tolist() == back and back.count(False) == 1
