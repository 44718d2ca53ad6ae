"""The corpus pipeline: five stages from documents to packed sequences.

Each stage takes the documents that its predecessor kept and returns a
DataFrame, which is written to shared scratch as Parquet and read again.

Cases, per stage as its operator states them: null and empty texts go in the
first stage (they fail its base test), as do very long ones only if the rules
reject them; documents without an id stay until they are packed; of repeated
rows the second stage keeps one; nulls in other columns and further columns are
kept up to the last stage; an empty table gives empty tables throughout.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trendflow.llm import mixing, ngram_join, packing, quality_rules, secret_scan
from trendflow.llm.common import discard, materialize, read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules accept."""
    return quality_rules.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return ngram_join.one_per_class(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked."""
    return secret_scan.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences, with their tokens."""
    return packing.pack(docs.select("doc_id", "text"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mix", mix),
    ("pack", pack),
]

#: Expectation-maximisation, a random forest and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, read = read_table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        made = stage(spark, docs, sf_dir)
        docs = materialize(made, name)
        # what the stage read and stored: its output is whole on shared storage
        discard(*read, *getattr(made, "held", []))
        read = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
