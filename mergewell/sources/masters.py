"""Record sources: the ``masters`` table of labels, from a table, JDBC, or derived from ``part``."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_WORDS = ("Finance", "Industries", "Motors", "Services", "Capital", "Foods", "Steel", "Consulting", "Global", "Textiles", "Hospital", "Software")
_MORE = ("", "", "", " North", " South", " Trading", " and Sons", " Works", " Bangla", " Exports", " Labs")
_DECORATED = {
    0: "{b} || ' Ltd'", 1: "{b} || ' Pvt. Ltd.'", 2: "upper({b})", 3: "lower({b})", 4: "', ' || {b}", 5: "{b} || ' ·'", 6: "{b} || ' · Full-time'",
    7: "{b} || ' (India)'", 8: "{b} || ', Mumbai, India'", 9: "'The  ' || {b}", 10: "'A &B ' || {b}", 11: "replace({b}, ' ', '')", 12: "{b} || ' Limitd'",
    13: "CASE WHEN p_partkey % 5 = 0 THEN 'N/A' WHEN p_partkey % 5 = 1 THEN 'Consultant' WHEN p_partkey % 5 = 2 THEN '12345' WHEN p_partkey % 5 = 3 THEN '-' ELSE '' END",
    14: "CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 3 = 1 THEN 'Regional Sales Manager' ELSE 'self employed' END",
}


def _choose(words: tuple[str, ...], index: str) -> str:
    return f"CASE {index} % {len(words)} " + " ".join(f"WHEN {i} THEN '{w}'" for i, w in enumerate(words)) + " END"


def masters_sql() -> str:
    """``id, label, type`` from ``part``, in SQL that Spark and DuckDB both read."""
    third = "CAST(floor(p_partkey / 3) AS BIGINT)"
    base = f"p_name || ' ' || ({_choose(_WORDS, third)}) || ({_choose(_MORE, 'CAST(floor(p_partkey / 7) AS BIGINT)')})"
    label = "CASE p_partkey % 19 " + " ".join(f"WHEN {k} THEN {v.format(b='base')}" for k, v in _DECORATED.items()) + " ELSE base END"
    kind = "CASE p_partkey % 10 WHEN 3 THEN 'Archived' WHEN 5 THEN 'Group' WHEN 7 THEN 'Companny' WHEN 9 THEN NULL ELSE 'Company' END"
    return f"SELECT p_partkey AS id, {label} AS label, {kind} AS type FROM (SELECT p_partkey, {base} AS base FROM part) AS b"


def derived_masters(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir.rstrip('/')}/part.parquet")
    return spark.sql(masters_sql().replace("FROM part)", "FROM {part})"), part=part)


def read_masters(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """``masters`` from any Spark source; JDBC sources take ``url``, ``dbtable`` and the partitioning options."""
    return spark.read.format(fmt).options(**options).load(path or None)


def marked_sql() -> str:
    """``masters`` with marks given by id, in SQL that Spark and DuckDB both read: what a run may leave behind, broken links included."""
    return f"""SELECT id, label, type,
      CASE WHEN id % 5 = 1 THEN 'primary' WHEN id % 5 IN (2, 3) THEN 'duplicate' WHEN id % 15 = 4 THEN 'probable' END AS duplicate_status,
      CASE WHEN id % 35 = 3 THEN NULL WHEN id % 45 = 8 THEN 100000000 + id WHEN id % 25 = 12 THEN id - 6 WHEN id % 5 = 2 THEN id - 1 WHEN id % 5 = 3 THEN id - 2 END AS duplicate_of,
      CASE WHEN id % 5 IN (2, 3) THEN CAST(0.75 + (id % 26) / CAST(100 AS DECIMAL(5,2)) AS DECIMAL(5,3)) END AS duplicate_score,
      CASE WHEN id % 20 IN (2, 4) THEN '{{"same_company":true}}' END AS ai_decision,
      CASE WHEN id % 91 = 1 THEN 'new' ELSE 'old' END AS record_type FROM ({masters_sql()}) AS m"""


def marked_masters(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir.rstrip('/')}/part.parquet")
    return spark.sql(marked_sql().replace("FROM part)", "FROM {part})").replace('{"same_company":true}', "{{\"same_company\":true}}"), part=part)


def with_retries(read: Callable[[], DataFrame], attempts: int = 10, pause: float = 5.0, wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """What ``read`` gives, tried again after ever longer waits: a source may be restarting when a job begins.

    Spark connects when it resolves the source's columns, so that is what is tried; tasks have retries of their own.
    """
    for attempt in range(1, attempts + 1):
        try:
            df = read()
            df.schema  # noqa: B018
            return df
        except Exception:
            if attempt == attempts:
                raise
            wait(pause * attempt)
    raise ValueError("attempts is at least 1")


def tables_of(spark: SparkSession) -> DataFrame:
    """Catalogue rows ``name, kind, temporary`` of the session's tables and views."""
    rows = [(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables()]
    return spark.createDataFrame(rows, "name string, kind string, temporary boolean")


def companies(masters: DataFrame) -> DataFrame:
    """The scan of one type; filter and columns reach the source."""
    return masters.where("type = 'Company'").select("id", "label")


def all_types(masters: DataFrame) -> DataFrame:
    return masters.select("id", "label", "type")


def not_blank(masters: DataFrame) -> DataFrame:
    return masters.where(F.col("label").isNotNull() & (F.trim("label") != ""))


def valid_rows(result: DataFrame) -> DataFrame:
    return result.where("is_valid = 1")


def columns_of(df: DataFrame) -> DataFrame:
    """Catalogue rows ``name, type, nullable`` of a table."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "name string, type string, nullable boolean")


def sample_labels(masters: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` distinct trimmed labels in order."""
    return masters.select(F.trim("label").alias("label")).where("label <> ''").distinct().orderBy("label").limit(n)
