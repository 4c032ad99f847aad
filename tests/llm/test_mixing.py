from collections import defaultdict

import pytest

import check_oracles
from tierflow.llm.mixing import mix_sources, mixed_stream, source_targets, word_count
from tierflow.llm.oracles import ORACLES
from tierflow.llm.queries import QUERIES


def sized(df):
    return df.select("doc_id", "source", word_count("text").alias("size"))


def brute_targets(sizes, weights, share, copies):
    """Water filling by rounds."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, target, open_ = share * sum(sizes.values()), {}, set(sizes)
    while open_:
        level = budget / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= copies * sizes[s]}
        if not full:
            return target | {s: weight[s] * level for s in open_}
        for s in full:
            target[s] = copies * sizes[s]
            budget -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5}, {None: 7, "x": 7}, {"a": 0, "b": 9}, {"only": 100}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in source_targets(df, (3, 1, 2), 1.5, 2).collect()}
    assert got == pytest.approx(brute_targets(sizes, (3, 1, 2), 1.5, 2))


def test_sources_reach_their_targets(documents):
    rows = mix_sources(sized(documents)).collect()
    taken, target = defaultdict(int), {}
    for r in rows:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert len(rows) == documents.count()
    assert all(0 <= target[s] - taken[s] < 1 for s in target)
    assert sum(target.values()) == pytest.approx(1.5 * sum(r["size"] for r in rows))


def test_query_equals_its_sql(spark, sf_dir):
    con = check_oracles.connect(sf_dir)
    assert check_oracles.compare(spark, con, sf_dir, "op5_mix_sources") is None
    assert set(ORACLES) <= set(QUERIES)


def test_stream_holds_the_words_taken(docs):
    rows = docs(*((i, f"  w{i} b\tc\n\nd e " if i % 3 else "q", "en", f"s{i % 2}") for i in range(40)))
    taken = {r["doc_id"]: r["taken"] for r in mix_sources(sized(rows)).collect()}
    words = defaultdict(int)
    for r in mixed_stream(rows).collect():
        words[r["doc_id"]] += len(r["text"].split())
        whole = rows.filter(f"doc_id = {r['doc_id']}").first()["text"]
        assert whole.startswith(r["text"])
    assert dict(words) == {k: v for k, v in taken.items() if v}


def test_awkward_rows(odd):
    mixed = mix_sources(sized(odd))
    assert mixed.count() == odd.count()
    assert mix_sources(sized(odd.limit(0))).collect() == []
    stream = mixed_stream(odd)
    assert stream.columns == odd.columns
    assert sum(len((r["text"] or "").split()) for r in stream.collect()) == sum(r["taken"] for r in mixed.collect())


def test_no_python_in_the_plan(documents):
    plan = mix_sources(sized(documents))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
