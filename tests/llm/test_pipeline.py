import pytest

import __spark_entry__ as contract
import corpus_pipeline


def test_stages_and_registration():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "secrets", "mix", "tokenize"]
    names = set(contract.queries())
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_each_stage_acts_on_what_the_last_one_kept(spark, sf_dir, documents):
    docs = documents
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), name)
        assert docs.schema == documents.schema or docs.columns == documents.columns
        ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
        if name == "quality":
            good = [i for i in labels if labels[i] == 1]
            assert len(set(good) & set(ids)) > 0.95 * len(good)
        if name == "near_duplicates":
            assert len(ids) == len(set(ids))
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert len(tokens) == docs.count() and all(r["round_trip"] for r in tokens)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_awkward_and_empty_tables(spark, sf_dir, odd, name, stage):
    plain = odd.select("doc_id", "text", "lang", "source", "n_chars")
    assert stage(spark, plain, sf_dir).count() <= 2 * plain.count()
    assert stage(spark, plain.limit(0), sf_dir).collect() == []


def test_run(spark, sf_dir):
    result = corpus_pipeline.run(spark, sf_dir)
    assert result.columns == ["doc_id", "token_ids", "n_tokens", "round_trip"]
    assert result.count() > 0
