"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.chats import format_chats, read_chats
from tierflow.llm.clusters import cluster_report, cluster_vectors
from tierflow.llm.common import small_batches, table
from tierflow.llm.language import fit_language, predict_language
from tierflow.llm.mixing import mix_sources, word_count
from tierflow.llm.neighbours import nearest
from tierflow.llm.pages import extract_main
from tierflow.llm.phrases import collocations
from tierflow.llm.pieces import encode_pieces, load_pieces
from tierflow.llm.quality import fit_quality, score_quality
from tierflow.llm.secrets import scan_secrets
from tierflow.llm.simhash import simhash_components
from tierflow.llm.suffixes import remove_repeats
from tierflow.llm.vectors import near_vectors

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return scan_secrets(table(spark, sf_dir, "documents"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    return predict_language(docs, fit_language(docs))


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return simhash_components(table(spark, sf_dir, "documents"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count("text").alias("size"))
    return mix_sources(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return extract_main(table(spark, sf_dir, "pages"))


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return encode_pieces(table(spark, sf_dir, "documents"), load_pieces())


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op9_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return collocations(table(spark, sf_dir, "documents"))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], chats.schema)
    return read_chats(format_chats(chats.unionByName(more)))


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_report(*cluster_vectors(table(spark, sf_dir, "embeddings")))


QUERIES: dict[str, Query] = {
    fn.__name__: fn
    for fn in (
        op1_secret_scan,
        op2_language,
        op3_nearest,
        op4_simhash,
        op5_mix_sources,
        op6_main_text,
        op7_pieces,
        op8_repeats,
        op9_near_vectors,
        op10_quality,
        op11_collocations,
        op12_chat_format,
        op13_clusters,
    )
}
