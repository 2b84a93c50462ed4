"""The corpus pipeline: quality rules, near-dedup, personal data, mixing, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.

Defined cases: null and empty texts, and texts of fewer than 50 words, are
rejected by the quality rules; null languages and sources are groups of their own;
of rows with one component the one with the least id stays (null ids last), so of
repeated rows one; texts of any length are taken whole; a document that the mix
takes several times is as many rows, one that it does not take is gone; an empty
table gives empty tables with the same columns; other columns pass through, and a
column ``ids`` is replaced by the token ids of the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stellate.llm.bpe import encode_documents
from stellate.llm.common import table
from stellate.llm.mixing import mix_documents
from stellate.llm.pii import redact
from stellate.llm.quality import quality_filter
from stellate.llm.simhash import drop_near_duplicates
from stellate.session import materialize


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_filter(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the least id."""
    return drop_near_duplicates(docs, shingle_words=4, max_bits=4)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind."""
    return redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids for every row."""
    return encode_documents(docs)


STAGES = [
    ("quality_rules", keep_good),
    ("simhash_near_dedup", drop_copies),
    ("pii", hide_personal_data),
    ("mix_sources", mix_sources),
    ("bpe_encode", encode),
]

#: Fingerprints, bootstrapped patterns, Newton steps and tokens are beyond
#: SQL; the tests check the survivors, texts and ids of run() by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
