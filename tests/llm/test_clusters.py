import hashlib

import numpy as np
import pytest

import check_oracles
from tierflow.llm.clusters import LARGEST, cluster_report, cluster_vectors, vantage_tree


def brute_nearest(vectors, centroids):
    square = ((vectors[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
    return square.argmin(axis=1), square.min(axis=1)


@pytest.mark.parametrize("k", [1, 2, 3, 16, 61])
@pytest.mark.parametrize("spread", [1, 3, 1000, LARGEST])
def test_tree_is_exact_with_ties(k, spread):
    draw = np.random.default_rng(k * spread % 97)
    centroids = draw.integers(-spread, spread + 1, (k, 6))
    # Small spreads make equal centroids and many ties.
    vectors = np.concatenate([draw.integers(-spread, spread + 1, (300, 6)), centroids])
    number, square = vantage_tree(centroids).nearest(vectors)
    want = brute_nearest(vectors, centroids)
    assert (number == want[0]).all() and (square == want[1]).all()


def test_tree_leaves_nodes_unopened(monkeypatch):
    draw = np.random.default_rng(3)
    centroids = draw.integers(0, 10_000, (64, 2))
    tree = vantage_tree(centroids)
    opened = []
    real = np.sqrt
    monkeypatch.setattr(np, "sqrt", lambda x, *a: opened.append(np.size(x)) or real(x, *a))
    tree.nearest(draw.integers(0, 10_000, (500, 2)))
    assert sum(opened) < 0.6 * 500 * 64


def brute(rows, k=16, rounds=3):
    kept = [(i, np.floor(64 * np.array(v, dtype=float)).astype(np.int64)) for i, v in rows if v is not None and len(v) == 64 and None not in v and np.isfinite(v).all()]
    mark = lambda row: (row[0] is None, hashlib.sha256(f"1:{row[0]}".encode()).hexdigest(), row[1].tolist())
    centroids = np.array([q for _, q in sorted(kept, key=mark)[:k]])
    x = np.array([q for _, q in kept])
    for _ in range(rounds):
        number, _ = brute_nearest(x, centroids)
        centroids = np.array([[int(s) // int((number == c).sum()) for s in x[number == c].sum(axis=0)] if (number == c).any() else centroids[c] for c in range(len(centroids))])
    number, square = brute_nearest(x, centroids)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    return sorted(((i, int(c), int(d), int(square[number == c].sum()), int(square.sum()), sha[c]) for (i, _), c, d in zip(kept, number, square)), key=repr)


def table(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return frame.selectExpr("*", "1 AS cluster", "2 AS q", "3 AS distance")


def test_awkward_vectors(spark):
    draw = np.random.default_rng(5)
    rows = [(i, v) for i, v in enumerate(draw.normal(size=(60, 64)).round(2).tolist())]
    rows += [(100 + i, rows[3][1]) for i in range(40)] + [(7, rows[7][1]), (8, rows[9][1]), (None, rows[5][1])]
    odd = [(200, None), (201, []), (202, [1.0] * 63), (203, [1.0] * 63 + [None]), (204, [float("nan")] * 64), (205, [float("inf")] * 64), (206, [0.0] * 64)]
    got = cluster_report(*cluster_vectors(table(spark, rows + odd)))
    rows = [(i, np.float32(v).tolist()) for i, v in rows]
    assert sorted(map(tuple, got.collect()), key=repr) == brute([*rows, odd[-1]])


def test_few_and_no_vectors(spark):
    rows = [(1, [0.5] * 64), (2, [-0.01] * 64), (2, [-0.01] * 64)]
    got = cluster_report(*cluster_vectors(table(spark, rows)))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)
    # Too large for exact distances, so none of the vectors that take part.
    assert cluster_vectors(table(spark, [(1, [3e30] * 64)]))[0].collect() == []
    assert cluster_report(*cluster_vectors(table(spark, []))).collect() == []


def test_query_equals_its_sql(spark, sf_dir):
    assert check_oracles.compare(spark, check_oracles.connect(sf_dir), sf_dir, "op13_clusters") is None
