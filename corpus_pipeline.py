"""Corpus pipeline: documents to packed training sequences, in five stages.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes it to the cluster's shared folder and reads it as the next stage's ``docs``.
All stages but the last return the columns of ``docs``.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pagegrain.llm import language, near_dedup, packing, pii, quality_rules  # noqa: E402
from pagegrain.llm.common import discard, table, written  # noqa: E402


#: Chunks that a packing worker remembers. An executor that has run four stages holds its full heap, so its workers get less than in a query of their own.
ENTRIES = 300_000


def apart(docs: DataFrame, *used: str) -> DataFrame:
    """``docs`` with the columns that a stage does not use under names that clash with none of its own."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c in used else f"__{i}_{c}") for i, c in enumerate(docs.columns)])


def together(rows: DataFrame, docs: DataFrame, *used: str) -> DataFrame:
    """The columns of ``docs`` again."""
    return rows.select(*[F.col(f"`{c}`" if c in used else f"`__{i}_{c}`").alias(c) for i, c in enumerate(docs.columns)])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Identifies the language of each text by the two steps of the operator (family, then pairwise machines inside it) and drops texts without one:
    null, without a letter, or with too few n-grams of the language that was predicted.

    The n-grams are learned from ``docs`` itself; where nothing is labelled, only texts without letters go.
    """
    model = language.train(docs, ~language.held_out())
    return together(language.recognised(apart(docs, "text"), model), docs, "text")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the base rule or the learned decision list rejects.

    A null or empty text has too few words and goes; repeated rows are judged alike; an empty table stays empty. Without labels only the base rule holds.
    """
    rules = quality_rules.train(docs, table(spark, sf_dir, "labels"))
    return together(quality_rules.judged(apart(docs, "text"), rules).where("kept"), docs, "text")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies."""
    return together(near_dedup.keep_one(apart(docs, "doc_id", "text")), docs, "doc_id", "text")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; ``n_chars`` is counted again. Null texts stay null, repeated rows are changed alike, no row goes."""
    return together(pii.redacted(apart(docs, "text", "n_chars"), pii.train(docs)), docs, "text", "n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences: the columns of the packing query. A null or empty text is a piece of one end id; every row, also a
    repeated one, is packed; an empty table gives no pieces."""
    import public_tokenizers

    pieces = packing.cut_documents(docs, public_tokenizers.path(packing.VOCABULARY), entries=ENTRIES)
    return packing.pack(pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language_id),
    ("quality", quality),
    ("near_copies", near_copies),
    ("personal_data", personal_data),
    ("packing", pack),
]

#: Tokens and learned machines cannot be expressed in SQL; tests compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        if before is not None:  # the table of the stage before is not read again
            discard(before)
        before = docs
    return docs
