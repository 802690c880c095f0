"""Corpus pipeline: language ID, quality rules, near-dedup, secret redaction, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; each but the last
returns the columns of ``documents`` (and any further ones, whatever their names).  Each says what
becomes of null and empty texts; long texts are read whole and an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ruleweave.llm import langid, neardup, packing, quality, secrets
from ruleweave.llm.common import read_table, written
from ruleweave.llm.queries import BYTE_BPE


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter (null, empty), or in which no language holds a third of the words, or of whose words the
    learned languages' lexicons know too few, go; repeated rows share one fate."""
    return langid.keep_identified(docs, langid.fit(docs))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that fail the base rules (null and empty ones do) or score below the fitted threshold go; repeated rows
    share one fate."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates stays, that of the smallest id, and of repeated rows one. Empty
    texts (null ones count as empty) are copies of each other."""
    return neardup.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked, no row goes; ``n_chars`` follows the text (null for a null text)."""
    masked = secrets.redact_secrets(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1024 tokens along the curve: one row per piece of a document (null text: the end token alone)."""
    return packing.pack(docs, **BYTE_BPE)


STAGES = [("language_id", language_id), ("quality_rules", quality_rules), ("near_dedup", near_dedup),
          ("redact_secrets", redact_secrets), ("pack", pack)]

#: No stage but the base rules can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
