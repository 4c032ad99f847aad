import numpy as np
import pytest
from pyspark.sql import functions as F

from tierflow.llm import neighbours, vectors
from tierflow.llm.neighbours import nearest
from tierflow.llm.vectors import hadamard, near_vectors


def table(spark, rows):
    schema = "vec_id long, embedding array<float>, label int"
    return spark.createDataFrame([(i, v, 0) for i, v in rows], schema).selectExpr("*", "1 AS class", "2 AS node", "3 AS n", "4 AS score")


ODD = [(90, None), (91, []), (92, [0.0] * 8), (93, [float("nan")] + [1.0] * 7), (94, [None] + [1.0] * 7), (95, [float("inf")] * 8), (None, [1.0] * 8), (96, [1.0, 2.0])]


def clustered(n=160, size=8):
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(12, size))
    x = centres[draw.integers(0, 12, n)] + draw.normal(size=(n, size)) * draw.choice([0.02, 0.15, 1.0], (n, 1))
    rows = [(i, v) for i, v in enumerate(x.astype(np.float32).tolist())]
    return rows + [(1000 + i, rows[i][1]) for i in range(30)]


def brute_links(rows, threshold):
    ids = [i for i, _ in rows]
    x = np.array([v for _, v in rows], dtype=float)
    near = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ (x / np.linalg.norm(x, axis=1, keepdims=True)).T >= threshold
    np.fill_diagonal(near, False)
    label = list(ids)
    while True:
        after = [min([label[a], *(label[b] for b in np.flatnonzero(near[a]))]) for a in range(len(ids))]
        if after == label:
            return {i: (int(near[a].sum()), label[a]) for a, i in enumerate(ids)}
        label = after


@pytest.mark.parametrize("block", [512, 4])
def test_links_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rows = clustered()
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_vectors(table(spark, rows)).collect()}
    assert got == brute_links(rows, 0.95)


def test_awkward_vectors_link_with_nothing(spark):
    rows = [*ODD, (1, [1.0] * 8), (2, [2.0] * 8), (2, [2.0] * 8)]
    got = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in near_vectors(table(spark, rows)).collect() if r["vec_id"] is not None)
    assert got == [(1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), *((i, 0, i, True) for i in (90, 91, 92, 93, 94, 95, 96))]
    assert near_vectors(table(spark, [])).collect() == []


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(1).normal(size=(5, 16))
    assert np.allclose(np.linalg.norm(hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(hadamard(hadamard(x)), x)


def brute_nearest(rows, query, k):
    x = dict(rows)
    scores = [(-float(np.dot(np.float64(x[query]), np.float64(v))), i) for i, v in rows if i != query]
    return [i for _, i in sorted(scores)[:k]]


def test_recall_against_brute_force(spark, sf_dir):
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in embeddings.collect()]
    found: dict[int, list] = {}
    for r in nearest(embeddings).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r)
    assert set(found) == {i for i, _ in rows if i % 20 == 0}
    hits = []
    for query, got in found.items():
        assert [r["rank"] for r in got] == list(range(1, 21))
        assert [(-r["score"], r["vec_id"]) for r in got] == sorted((-r["score"], r["vec_id"]) for r in got)
        hits.append(len({r["vec_id"] for r in got} & set(brute_nearest(rows, query, 20))) / 20)
    assert np.mean(hits) >= 0.9


def test_search_of_few_and_awkward_vectors(spark):
    rows = [(0, [1.0] * 8), (1, [2.0] * 8), (2, [1.0] * 8), (2, [1.0] * 8), (20, [3.0] + [0.0] * 7), *ODD]
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in nearest(table(spark, rows)).orderBy("query_id", "rank").collect()]
    assert got == [
        (0, 1, 1, 16.0), (0, 2, 2, 8.0), (0, 3, 20, 3.0), (0, 4, 96, 3.0),
        (20, 1, 1, 6.0), (20, 2, 0, 3.0), (20, 3, 2, 3.0), (20, 4, 96, 3.0),
    ]
    assert nearest(table(spark, [])).collect() == []


def test_search_goes_on_until_all_is_expanded(spark, monkeypatch):
    calls = []

    def slow(pools, around, *rest):
        calls.append(1)
        return pools.withColumn("done", F.transform("done", lambda x: F.lit(len(calls) >= 20)))

    monkeypatch.setattr(neighbours, "_walk", slow)
    nearest(table(spark, [(i, [1.0, float(i)]) for i in range(3)]))
    assert len(calls) == 20


def test_recall_with_mixed_norms(spark):
    draw = np.random.default_rng(6)
    x = draw.normal(size=(400, 64))
    # Norms over two orders of magnitude, and queries near the short ones.
    x *= (10 ** draw.uniform(-1, 1, (400, 1))) / np.linalg.norm(x, axis=1, keepdims=True)
    x[0] *= 1000 / np.linalg.norm(x[0])
    rows = [(i, v) for i, v in enumerate(x.astype(np.float32).tolist())]
    hits = {}
    for r in nearest(table(spark, rows)).collect():
        hits.setdefault(r["query_id"], set()).add(r["vec_id"])
    recall = [len(got & set(brute_nearest(rows, q, 20))) / 20 for q, got in hits.items()]
    assert len(recall) == 20 and np.mean(recall) >= 0.97


@pytest.mark.parametrize("copies", [60, 400])
def test_copies_leave_recall_and_ties_right(spark, copies):
    draw = np.random.default_rng(9)
    x = draw.normal(size=(200, 16)).astype(np.float32)
    common = draw.normal(size=16).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(x.tolist())] + [(1000 + i, common) for i in range(copies)]
    found: dict[int, list] = {}
    for r in nearest(table(spark, rows)).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert set(found) == {i for i, _ in rows if i % 20 == 0}
    assert all([rank for rank, _ in got] == list(range(1, 21)) for got in found.values())
    recall = {q: len({i for _, i in got} & set(brute_nearest(rows, q, 20))) / 20 for q, got in found.items()}
    assert min(recall[q] for q in recall if q >= 1000) == 1 and np.mean(list(recall.values())) >= 0.95


def test_only_copies(spark):
    rows = [(i, [1.0, 2.0]) for i in range(30)]
    got: dict[int, list] = {}
    for r in nearest(table(spark, rows)).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == {0: [(i, 5.0) for i in range(1, 21)], 20: [(i, 5.0) for i in range(20)]}
