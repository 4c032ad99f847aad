import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import check_oracles
from tierflow.llm import phrases
from tierflow.llm.phrases import Frequent, collocations


def brute(rows, least=30, top=2000):
    f = defaultdict(Counter)
    sizes = Counter()
    for lang, text in rows:
        lang = lang or "und"
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for m in range(1, 5):
                f[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        kept = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and inside(p, q) for q, b in candidates.items()):
                continue
            cuts = [(2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


def awkward():
    draw = np.random.default_rng(7)
    words = ["a", "b", "c", "New", "york", "É", "日本", "x\x00y", "\x85z"]
    rows = []
    for number in range(150):
        some = [words[i] for i in draw.integers(0, len(words), 60)]
        glue = draw.choice([" ", "\t", "  ", ". ", ",", "\x0b"], 60, p=[0.6, 0.1, 0.1, 0.1, 0.05, 0.05])
        rows.append((["en", None, "de"][number % 3], "".join(w + g for w, g in zip(some, glue))))
    rows += [("en", "of the new york times of the new york times " * 40)] * 3
    rows += [("en", None), ("en", ""), (None, " \t\n"), ("fr", "one two"), ("en", "." * 50), ("long", "p q r s t " * 30_000)]
    return rows


@pytest.mark.parametrize("chunk, hot, bits", [(phrases.CHUNK, phrases.HOT, phrases.BITS), (2000, 4, 64)])
def test_equals_brute_force(spark, monkeypatch, chunk, hot, bits):
    # Small chunks split every stripe, few hot words shard many, and a filter of 64 bits lets all through.
    monkeypatch.setattr(phrases, "CHUNK", chunk)
    monkeypatch.setattr(phrases, "HOT", hot * 16 if hot == 4 else hot)
    monkeypatch.setattr(phrases, "BITS", bits)
    rows = awkward()
    frame = spark.createDataFrame(rows, "lang string, text string")
    frame = frame.selectExpr("*", "1 AS phrase", "2 AS f", "3 AS shard").repartition(5)
    got = sorted(map(tuple, collocations(frame).collect()))
    assert got == brute(rows)


def test_top_and_empty(spark):
    rows = awkward()
    frame = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(map(tuple, collocations(frame, least=20, top=7).collect())) == brute(rows, 20, 7)
    assert collocations(frame.limit(0)).collect() == []
    assert collocations(frame.filter("lang = 'fr'")).collect() == []


def test_filter_holds_what_is_in_it():
    codes = phrases.phrase_hashes(["en", "en", "de"], ["a b", "b", "a b"])
    assert len(set(codes.tolist())) == 3
    bits = np.zeros(phrases.BITS // 64, dtype=np.int64)
    for spot in phrases._spots(codes[:1], phrases.BITS):
        np.bitwise_or.at(bits, spot >> 6, np.left_shift(np.int64(1), spot & 63))
    assert Frequent(bits, codes[:0]).holds(codes).tolist() == [True, False, False]


def test_query_equals_its_sql(spark, sf_dir):
    assert check_oracles.compare(spark, check_oracles.connect(sf_dir), sf_dir, "op11_collocations") is None
