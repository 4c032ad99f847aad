"""The corpus pipeline: stages over documents, each reading what the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.common import small_batches, stored, table
from tierflow.llm.mixing import mixed_stream
from tierflow.llm.pieces import encode_pieces, load_pieces
from tierflow.llm.quality import fit_quality, keep_quality
from tierflow.llm.secrets import redact_secrets
from tierflow.llm.simhash import keep_one_per_group

#: Quality and duplicates are judged by trained or iterative code, so SQL cannot
#: state the rows; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It is fitted on these documents."""
    small_batches(spark)
    return keep_quality(docs, fit_quality(docs))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: fingerprints of three-word
    shingles that link within two bits."""
    small_batches(spark)
    return keep_one_per_group(docs, words=3, distance=2)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the text are replaced by a mark; every document stays. ``n_chars``
    follows the text."""
    small_batches(spark)
    clean = redact_secrets(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them, in mix order."""
    return mixed_stream(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the mixed documents."""
    small_batches(spark)
    return encode_pieces(docs, load_pieces())


STAGES = [
    ("quality", quality),
    ("near_duplicates", deduplicate),
    ("secrets", redact),
    ("mix", mix),
    ("tokenize", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are stored for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
