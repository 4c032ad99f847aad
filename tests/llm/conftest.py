import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """A documents table of (doc_id, text) or (doc_id, text, lang, source) rows."""

    def make(*rows):
        full = [(*row, *("en", "s")[len(row) - 2 :], len(row[1] or ""))[:5] for row in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def odd(docs):
    """The awkward cases in one table: null and empty texts, a null id, repeated rows,
    a very long text, and columns named like those that operators add."""
    long = " ".join(f"word{i % 977} follows." for i in range(20_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "One two three four five six seven."), (4, "One two three four five six seven."),
        (None, "One two three four five six seven."), (5, long), (6, "é ü 日本 🦊"), (7, "x"), (8, None, None, None),
    ]
    extra = {name: F.lit(1) for name in ("key", "row", "size", "group", "fp", "finish", "node", "score", "keep")}
    return docs(*rows).withColumns(extra)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
