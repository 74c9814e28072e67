"""The registered queries of this package: name -> (spark, sf_dir) -> DataFrame, and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickflow.llm import alignment, checks, decontam, extract, kneser, langid, mixing, near_dedup, pii, quality, substrings, toxicity, trie, warc
from tickflow.llm.frames import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.report(table(spark, sf_dir, "pages"))


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(table(spark, sf_dir, "documents"))


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser.report(table(spark, sf_dir, "documents"))


@query
def op7_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(spark, table(spark, sf_dir, "pages"))


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.report(table(spark, sf_dir, "documents"))


MIX = mixing.Mix(
    domains={"domain0": 0.4, "domain1": 0.3, "domain2": 0.2, "domain3": 0.1},
    languages={"en": 0.5, "fr": 0.2, "de": 0.2, "es": 0.1},
)


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"), MIX)


SQL["op9_mixing"] = mixing.sql(MIX)


@query
def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.report(table(spark, sf_dir, "documents"), n=4)


@query
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.report(table(spark, sf_dir, "conversations"))


@query
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(table(spark, sf_dir, "documents"))


SQL["op3_decontamination"] = checks.DECONTAMINATION
SQL["op7_arc_to_warc"] = checks.ARCHIVES
SQL["op8_substring_dedup"] = checks.SUBSTRINGS
SQL["op10_minhash_near_dedup"] = checks.NEAR_DUPLICATES
SQL["op11_conversation_trie"] = checks.CONVERSATIONS
