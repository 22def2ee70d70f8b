"""The corpus pipeline: documents in, packed token sequences out.

``STAGES`` are applied in order; every stage works on all rows that the one before it kept. All
but the last return the columns of documents, so a stage's decisions show in what it keeps.

Every stage takes any table with the columns of documents, further columns of any name included, and an empty one gives an
empty one. Texts are read whole, however long.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from logloom.llm.exact_dedup import keep_distinct
from logloom.llm.jaccard import keep_one_per_group
from logloom.llm.packing import pack_documents
from logloom.llm.secrets import redact_live
from logloom.llm.toxicity import drop_toxic
from logloom.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain calls toxic go.

    Null texts count as empty. Every row is judged by itself, repeated ones alike; without labelled documents all stay.
    """
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays: the longest original text, then the smallest id.

    Null texts are equal to empty ones. Of rows that agree in id and text one stays; null ids come last.
    """
    return keep_distinct(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays.

    Texts without words (or null) link with nothing and stay. Of rows that share an id the largest text stays; rows without an id stay.
    """
    return keep_one_per_group(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Credentials that look live are taken out of the texts; all documents stay.

    Null texts stay null. A null source is an owner of its own. Repeated rows repeat.
    """
    return redact_live(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token pieces in sequences.

    A null text counts as empty and gives one piece, the end token. Every row is packed, repeated ones too.
    """
    # Workers of the stages before still hold memory, so the memo is small here.
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), memo=100_000)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_copies),
    ("ngram_jaccard", near_copies),
    ("secret_scan", secrets),
    ("best_fit_packing", packing),
]

# A fitted classifier comes first, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
