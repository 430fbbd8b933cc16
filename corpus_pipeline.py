"""Training-data pipeline over ``documents``.

Five stages, each on all that the one before kept: toxic documents go, one document of each group of
near-duplicates stays, documents with benchmark passages go, sources are mixed to target weights, and
the rest becomes token files, read back as a row per document.  All but the last return the columns of
``documents``, whatever their names and however many.  Several stages train or align and can't be said in
SQL, so they are tested against brute force.

Defined results: a null text is an empty one and a null source the source ``''``; both pass all stages.  Rows without
an id are judged by their text and link to nothing.  Of rows that share an id the least by all columns stays.
With labels of one class only, or none, every document has the share of toxic labels as its score.  An
empty benchmark marks nothing, and an empty table of documents gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mergewell.llm import decontaminate, minhash, mixing, token_output, toxicity
from mergewell.llm.common import drop_materialized, free_name, materialize, table

#: No source is read more often than this, and none less than once.
REPETITION_LIMIT = 1.25


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the operator's threshold; every other one goes."""
    score = free_name("score", docs)
    scored = toxicity.with_toxicity(docs, docs, table(spark, sf_dir, "labels"), column=score)
    return scored.where(F.col(score) < toxicity.THRESHOLD).drop(score)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group stays."""
    return minhash.one_of_each_group(docs)


def remove_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no test item aligns."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, as often as its source's weight asks, in the order of the mixture: nothing is lost, small sources repeat."""
    return mixing.mixed_stream(docs, repetition_limit=REPETITION_LIMIT)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back."""
    return token_output.read_token_files(token_output.write_token_files(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", remove_toxic),
    ("near duplicates", remove_near_duplicates),
    ("benchmark decontamination", remove_benchmark_leaks),
    ("source mixing", mix_sources),
    ("token output", write_tokens),
]

#: Scores, minima and alignments can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again; a stage's table is deleted once the next is written."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, "stage")
        drop_materialized(before)
    return docs
