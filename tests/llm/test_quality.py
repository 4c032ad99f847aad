import numpy as np
import pytest

from tierflow.llm.quality import estimate_accuracies, facts, features, fit_quality, keep_quality, score_quality


def test_agrees_with_the_labels(spark, sf_dir, documents):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = score_quality(documents, fit_quality(documents)).join(labels, "doc_id").collect()
    good, bad = [[r["keep"] for r in rows if r["quality"] == q] for q in (1, 0)]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.1


def test_accuracies_without_labels():
    draw = np.random.default_rng(2)
    truth = draw.random(20_000) < 0.7
    right = (0.95, 0.85, 0.75, 0.9)
    counts: dict[str, int] = {}
    for t in truth:
        pattern = "".join("+" if t == (draw.random() < p) else "-" for p in right)
        counts[pattern] = counts.get(pattern, 0) + 1
    share, given, posterior = estimate_accuracies(counts)
    assert share == pytest.approx(0.7, abs=0.03)
    assert [given[i, 1, 1] for i in range(4)] == pytest.approx(right, abs=0.03)
    assert posterior["++++"] > 0.95 and posterior["----"] < 0.05
    assert estimate_accuracies({}) [2] == {}


def test_awkward_rows(odd):
    model = fit_quality(odd)
    rows = score_quality(odd, model).collect()
    assert len(rows) == odd.count() and not any(r["keep"] for r in rows if r["doc_id"] in (1, 2, 3, 8))
    assert keep_quality(odd, model).columns == odd.columns
    empty = odd.limit(0)
    assert score_quality(empty, fit_quality(empty)).collect() == []


def test_long_word_shapes_are_told_apart():
    first, second = (b"a1b2c3d4e5" + end for end in (b"f6", b"!?"))
    assert set(features(first, facts(first))) != set(features(second, facts(second)))
