"""The registered queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from casebook.llm import divergence, mixing, pieces
from casebook.llm.common import fold_of, table
from casebook.llm.compression_quality import learn_compression, score_quality
from casebook.llm.fm_index import contamination
from casebook.llm.language_filters import learn_filters, predict_languages
from casebook.llm.ngram_jaccard import jaccard_components
from casebook.llm.pivot_index import near_vectors
from casebook.llm.secret_layers import secret_spans
from casebook.llm.shallot import ORACLE as SHALLOT_ORACLE
from casebook.llm.shallot import cluster_vectors
from casebook.llm.suffix_repeats import cut_repeats
from casebook.llm.toxicity import learn_toxicity, score_toxicity
from casebook.llm.warc import archived_pages


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), k=3, percent=90)


def op2_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold_of("doc_id", 5) == 0
    model = learn_compression(documents, labels, ~held_out)
    scored = score_quality(documents.select("doc_id", held_out.alias("held_out"), "text"), model)
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


def op3_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_repeats(table(spark, sf_dir, "documents"))


def op4_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op5_secret_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = fold_of("doc_id", 4)
    model = learn_toxicity(documents, labels, fold != 2, fold == 3)
    scored = score_toxicity(documents.select("doc_id", (fold == 2).alias("held_out"), "text"), model)
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


def op7_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op8_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = fold_of("doc_id", 3) == 1
    filters = learn_filters(documents, ~held_out)
    return predict_languages(documents.select("doc_id", held_out.alias("held_out"), "text"), filters)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(table(spark, sf_dir, "pages"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.digests(table(spark, sf_dir, "documents"), model)


def op12_shallot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings")).drop("centroid")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_compression_quality": op2_compression_quality,
    "op3_suffix_repeats": op3_suffix_repeats,
    "op4_pivot_index": op4_pivot_index,
    "op5_secret_layers": op5_secret_layers,
    "op6_toxicity": op6_toxicity,
    "op7_fm_index": op7_fm_index,
    "op8_language_filters": op8_language_filters,
    "op9_warc": op9_warc,
    "op10_mixing": op10_mixing,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_shallot_clusters": op12_shallot_clusters,
    "op13_source_divergence": op13_source_divergence,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {"op10_mixing": mixing.ORACLE, "op12_shallot_clusters": SHALLOT_ORACLE, "op13_source_divergence": divergence.ORACLE}
DEFINITIONS: dict[str, str] = {}
