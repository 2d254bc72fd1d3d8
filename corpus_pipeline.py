"""Corpus pipeline: toxicity filter, near-duplicate removal, PII masking, source mix, piece encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as
the next stage's ``docs``. All stages but the last return the columns of ``documents``, in their order.
Nulls, empty texts, repeated rows and empty tables are treated as the operators' docstrings say; columns
beyond those of ``documents`` are carried along up to the last stage.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelforge.llm import jaccard, mixing, pii, sentencepieces, toxicity
from panelforge.llm.common import scratch_table, table
from panelforge.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold, under a model learned from the labelled ones."""
    return toxicity.drop_toxic(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group linked by shingle Jaccard >= 0.75."""
    return jaccard.one_per_group(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with e-mail and IP addresses, card and phone numbers replaced by marks."""
    return pii.mask_pii(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's budget takes them, the last one of a source in part."""
    return mixing.mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_pieces, pieces``: the texts as piece ids."""
    return (sentencepieces.encode_documents(docs, tokenizer_path())
            .select("doc_id", "lang", "source", F.size("pieces").cast("long").alias("n_pieces"), "pieces"))


STAGES = [("toxicity", drop_toxic), ("near_copies", drop_near_copies), ("personal_data", mask_personal_data),
          ("source_mix", mix_sources), ("piece_encoding", encode_pieces)]

#: Learned scores, automata and segmentation can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
