"""A corpus from raw documents: language, near-duplicates, benchmark passages, personal data, mixture.

Every stage takes a table without rows (and gives one), keeps columns it does not know, whatever their names,
and reads texts of any length whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickflow.llm import decontam, langid, mixing, near_dedup, pii
from tickflow.llm.catalog import MIX
from tickflow.llm.frames import stage, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language cannot be told.

    Null texts, texts without letters and those told with a score below one half go; a null ``lang`` or id does not matter. Equal texts share their fate.
    """
    return langid.accept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies (five-word shingles, similarity 0.8).

    The smallest id of a group stays, with all rows that repeat it. Null and wordless texts are copies of nothing.
    """
    return near_dedup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of the benchmark.

    Null texts hold none; an empty benchmark drops nothing; rows that repeat an id are judged each by its text.
    """
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask personal data in the texts. All rows stay; null texts stay null."""
    return pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents to the target weights; ``epochs`` says how often each is taken.

    Null or empty texts are never taken; null languages and sources are the leaves ``und`` and ``unknown``; rows with
    one id are in one place of the order and are taken alike.
    """
    return mixing.mixed(docs, MIX)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mixture", mixture),
]

ORACLE_SQL = None
"""Language, masking and near-duplicates are not expressible; tests compare with a plain version."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
