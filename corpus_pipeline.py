"""Corpus pipeline: language ID, near-duplicate join, repeated passages,
benchmark decontamination, tokenization.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame that is written and read again as the next
one's ``docs``.  All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickscope.llm import decontamination, jaccard_join, language_id, sentencepiece_codec, substring_dedup
from clickscope.llm.queries import tokenizer_file
from clickscope.llm.tables import read
from clickscope.session import cut_lineage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without an identifiable language."""
    return language_id.drop_unidentified(docs)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates."""
    return jaccard_join.keep_one(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that an earlier document has out of later ones."""
    return substring_dedup.remove_passages(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold benchmark passages."""
    return decontamination.drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes and decodes the texts that are left."""
    return sentencepiece_codec.round_trip(docs, tokenizer_file("piece_bpe_32k.model"), with_ids=False)


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", join_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("decontamination", drop_benchmark_leaks),
    ("sentencepiece", encode_pieces),
]

#: Language models, fuzzy chains and tokenizers have no SQL form; the stages
#: are tested one by one and together against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
