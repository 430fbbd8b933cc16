"""Registered queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import brown_lm, decontaminate, exact_dedup, html_extract, minhash, mixing, pii, token_output, toxicity, url_rules
from .common import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_spans(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.read_token_files(token_output.write_token_files(table(spark, sf_dir, "documents")))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.lm_scores(table(spark, sf_dir, "documents"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(table(spark, sf_dir, "pages"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most two passes over any source, no source short of one pass."""
    return mixing.mixed(table(spark, sf_dir, "documents"), repetition_limit=2.0).select("doc_id", "source", "n_tokens", "weight", "exponent", "copies", "places")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_toxicity": op2_toxicity,
    "op3_url_rules": op3_url_rules,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_token_output": op5_token_output,
    "op6_decontaminate": op6_decontaminate,
    "op7_brown_lm": op7_brown_lm,
    "op8_minhash": op8_minhash,
    "op9_html_extract": op9_html_extract,
    "op10_mixing": op10_mixing,
}
ORACLE_SQL: dict[str, str] = {"op4_exact_dedup": exact_dedup.ORACLE}
