import zlib

import numpy as np

from tierflow.llm import language
from tierflow.llm.language import Network, fit_language, held_out, predict_language


def test_gradients_are_those_of_the_loss():
    net, words, target = Network.fresh(["a", "b", "c"]), [b"hello", b"a", b"worldly"], np.array([0, 1, 2])

    def loss():
        data, sizes = language._matrix(words)
        probability = language._softmax(net._outputs(data, sizes).astype(np.float64))
        inside = np.arange(data.shape[1])[:, None] < sizes
        return -(np.log(probability[:, np.arange(3), target]) * inside).sum() / inside.sum()

    for weight, slope in zip(net.weights(), net.learn(words, target)):
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        value = weight[at]
        weight[at] = value + 1e-2
        above = loss()
        weight[at] = value - 1e-2
        assert abs((above - loss()) / 2e-2 - slope[at]) < 1e-3
        weight[at] = value


def test_held_out_accuracy(documents):
    net = fit_language(documents)
    rows = predict_language(documents, net).join(documents.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_held_out_labels_are_not_used(documents):
    from pyspark.sql import functions as F

    changed = documents.withColumn("lang", F.when(held_out(), F.lit("zz")).otherwise(F.col("lang")))
    first, second = fit_language(documents, sample_words=200), fit_language(changed, sample_words=200)
    assert first.languages == second.languages and np.array_equal(first.output, second.output)


def test_awkward_rows(odd, docs):
    net = fit_language(odd, sample_words=100)
    by = {r["doc_id"]: r for r in predict_language(odd, net).collect()}
    assert [by[i]["lang_pred"] for i in (1, 2, 3, 8)] == ["und"] * 4 and by[1]["score"] == 0
    assert by[6]["lang_pred"] == "en" and not by[None]["held_out"]
    assert predict_language(docs((9, "123 !?")), net).first()["lang_pred"] == "und"
    nothing = fit_language(odd.limit(0))
    assert predict_language(docs((9, "words")), nothing).first()["lang_pred"] == "und"
    assert predict_language(odd.limit(0), net).collect() == []


def test_long_words_are_learned_from_and_forgotten_by_bytes(docs, monkeypatch):
    # Both languages begin each word alike and differ behind the first part.
    rows = [(i, "q" * language.STEPS + ("ab" if i % 2 else "xy") * 20, "one" if i % 2 else "two", "s") for i in range(40)]
    net = fit_language(docs(*rows), sample_words=500)
    got = predict_language(docs((90, "abab" * 9), (91, "xyxy" * 9)), net).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in got} == {90: "one", 91: "two"}
    monkeypatch.setattr(language, "MEMORY_BYTES", 100)
    labeller = language.Labeller(net)
    for n in range(5):
        labeller.predict([chr(97 + n) * 300])
        assert len(labeller.known) == 1
