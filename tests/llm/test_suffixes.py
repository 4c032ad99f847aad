import hashlib
import random
from collections import Counter

import pytest

from tierflow.llm import suffixes
from tierflow.llm.suffixes import LoserTree, anchors, common, front_code, remove_repeats, repeated_starts


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = sum(gone[i] and (i == 0 or not gone[i - 1]) for i in range(len(d)))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def result(df, length):
    return [(r["doc_id"], (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])) for r in remove_repeats(df, length).collect()]


@pytest.mark.parametrize("together", [suffixes.TOGETHER, 3, 1])
def test_random_texts_match_brute_force(docs, monkeypatch, together):
    monkeypatch.setattr(suffixes, "TOGETHER", together)
    draw = random.Random(5)
    pool = ["".join(draw.choice("abcé ") for _ in range(90)) for _ in range(12)]
    texts = ["".join(draw.choice(pool)[draw.randint(0, 30) : draw.randint(40, 90)] for _ in range(draw.randint(0, 12))) for _ in range(120)]
    texts += ["ab " * 100, "ab " * 37, "x" * 300, None, texts[0], texts[0]]
    assert sorted(result(docs(*enumerate(texts)), 60)) == list(enumerate(brute(texts, 60)))


def test_documents_match_brute_force(documents):
    rows = documents.select("doc_id", "text").orderBy("doc_id").collect()
    want = brute([r["text"] for r in rows], 200)
    assert sum(w[1] for w in want) > 0
    assert sorted(result(documents, 200)) == [(r["doc_id"], w) for r, w in zip(rows, want)]


def test_awkward_rows(odd):
    rows = result(odd, 20)
    texts = [r["text"] for r in odd.collect()]
    assert sorted(w for _, w in rows) == sorted(brute(texts, 20))
    assert result(odd.limit(0), 20) == []


def test_loser_tree_knows_common_prefixes():
    draw = random.Random(7)
    for _ in range(200):
        runs = [sorted({bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 8))) for _ in range(draw.randint(0, 12))}) for _ in range(draw.randint(1, 7))]
        merged = [(s, k) for _, _, s, k in LoserTree([front_code(run) for run in runs])]
        assert [s for s, _ in merged] == sorted(s for run in runs for s in run)
        assert all(k == common(a, b) for (a, _), (b, k) in zip(merged, merged[1:]))


def test_repeated_starts_match_brute_force():
    draw = random.Random(8)
    for _ in range(400):
        length = draw.randint(1, 6)
        sides = [tuple(bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 7))) for _ in "lr") for _ in range(draw.randint(2, 12))]
        sides.sort(key=lambda side: side[1])
        lefts, rights = [a for a, _ in sides], [b for _, b in sides]
        ahead = [0, *(common(a, b) for a, b in zip(rights, rights[1:]))]
        got = repeated_starts(lefts, ahead, length)
        for i, (left, right) in enumerate(sides):
            want = set()
            for j, (other, behind) in enumerate(sides):
                shared, ending = common(right, behind), common(left[::-1], other[::-1])
                want.update(b for b in range(ending + 1) if i != j and b + shared >= length)
            assert {b for low, high in got[i] for b in range(low, high + 1)} == want
            assert all(low <= high for low, high in got[i]) and all(a[0] > b[1] + 1 for a, b in zip(got[i], got[i][1:]))


def test_near_copies_make_no_more_suffixes_than_contexts(docs, monkeypatch):
    rows = {}
    plain = suffixes.ordered
    draw = random.Random(3)
    base = [f"w{draw.randint(0, 999)}" for _ in range(120)]

    def counted(df):
        rows["suffixes"] = df.count()
        return plain(df)

    monkeypatch.setattr(suffixes, "ordered", counted)
    seen = []
    for copies in (20, 40, 80):
        texts = []
        for _ in range(copies):
            words = list(base)
            for place in draw.sample(range(120), 6):
                words[place] = f"x{draw.randint(0, 10**6)}"
            texts.append(" ".join(words))
        assert sorted(result(docs(*enumerate(texts)), 60)) == list(enumerate(brute(texts, 60)))
        seen.append(rows["suffixes"])
    assert seen[2] < 2.5 * seen[1] < 6.25 * seen[0]


def test_equal_strings_have_equal_anchors():
    draw = random.Random(9)
    shared = bytes(draw.choice(b"abcd") for _ in range(200))
    found = []
    for _ in range(5):
        before = bytes(draw.choice(b"abcd") for _ in range(draw.randint(0, 50)))
        value, _, low, high, at = anchors(before + shared + before)
        place = [i for i in range(len(low)) if low[i] <= len(before) <= high[i]][0]
        found.append((value[place], at[place] - len(before)))
    assert len(set(found)) == 1
