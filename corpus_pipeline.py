"""The text pipeline: language, toxicity, near-duplicates, mixture, then pieces.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all but the last return the
columns of documents. Extra columns pass through, whatever they are called. Null and empty texts and texts
without letters go in the first stage (they have no language); rows that repeat a doc_id are one document to
the third stage; null doc_ids are never near duplicates; null sources are a source of their own in the
fourth; an empty table passes through as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm import langid, minhash, mixing, pieces, toxicity
from siftwell.session import read_table
from siftwell.tables import drop, settled


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the table teaches."""
    return langid.keep_known(docs)


def clean_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    return toxicity.keep_clean(docs, read_table(spark, sf_dir, "labels"))


def first_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: links join sets of a similarity of 0.8 or more."""
    return minhash.deduplicate(docs, link=80)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, with what proves the round trip."""
    return pieces.encode(docs).withColumn("n_ids", F.size("ids").cast("long"))


STAGES = [
    ("language", known_languages),
    ("toxicity", clean_texts),
    ("near_duplicates", first_of_each),
    ("mixture", mixed_sources),
    ("pieces", encoded),
]

#: Learned models and the piece search are beyond SQL; tests/llm/test_pipeline.py and test_learned.py hold the stages
#: against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        # a later stage scans its input more than once: no stage runs again for that
        docs = settled(lambda docs=docs, stage=stage: stage(spark, docs, sf_dir))
        if before is not None:
            drop(before)
        before = docs
    return docs
