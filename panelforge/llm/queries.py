"""Registered queries of the corpus operators: each applies its operator to its whole table."""
from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from panelforge.llm import embedding_dedup, html_text, jaccard, mixing, pii, quality, sentencepieces, substring_dedup, token_alignment, token_counts, topk, toxicity, whitening
from panelforge.llm.common import table
from panelforge.llm.sql import MIX_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {"op4_source_mix": MIX_SQL}
PIECE_MODEL, BYTE_MODEL = "piece_bpe_32k.model", "byte_bpe_50k.json"


def _register(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str = PIECE_MODEL) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@_register
def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


@_register
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model)


@_register
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path())


@_register
def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.mix_sources(table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken"))


@_register
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_documents(table(spark, sf_dir, "documents"))


@_register
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


@_register
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


@_register
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encoded_digest(table(spark, sf_dir, "documents"), tokenizer_path())


@_register
def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


@_register
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_main_text(table(spark, sf_dir, "pages"))


@_register
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_tokenizers(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_MODEL),
                                            tokenizer_path(PIECE_MODEL))


@_register
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_vectors(table(spark, sf_dir, "embeddings"))


@_register
def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
