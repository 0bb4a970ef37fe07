"""A training corpus from raw documents: five stages, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillgrid.llm import jaccard, mixing, pieces, quality_model, quality_rules
from quillgrid.llm.common import read, table

#: The attention model and the mix cannot be written as SQL.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    Null, empty and very long texts, repeated rows, null ids, ties, empty tables and extra columns as in quality_model.quality_filter.
    """
    return quality_model.quality_filter(docs, read(spark, sf_dir, "labels"), quality_model.learnable())


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go, null and empty texts among them. Odd rows as in quality_rules.quality_filter."""
    return quality_rules.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id. Texts without words and rows without an id are in no group and stay.
    Odd rows as in jaccard.keep_one."""
    return jaccard.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, 0 to 2 times; texts without words aren't taken. Odd rows as in mixing.mixed_documents."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and decoded of what is left, one row per copy; null texts have no ids. Odd rows as in pieces.sentencepiece_round_trip."""
    encoded = pieces.sentencepiece_round_trip(docs)
    return encoded.select("doc_id", "ids", "decoded")


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", rules),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`. Rows: doc_id, ids, decoded; a document that the mix takes twice has two rows.

    Null, empty and very long texts, repeated rows, null ids and ties are dealt with by the stages as they say; an empty table gives an empty result.
    """
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
