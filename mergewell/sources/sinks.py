"""Result tables and their upkeep; tables are immutable, so an update is a new table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATUS_COLUMNS = {
    "duplicate_status": "string",
    "duplicate_of": "bigint",
    "duplicate_score": "decimal(5,3)",
    "ai_decision": "string",
    "record_type": "string",
}


#: Columns of result tables; the profiles of one type have no ``source_type``.
RESULT_SCHEMA = "id bigint, company_name string, original_name string, master_id bigint, source_type string, group_id bigint, is_primary int, is_valid int, filter_reason string"
FINAL_SCHEMA = "id bigint, company_name string, master_id bigint, group_id bigint, is_primary int"


def conform(df: DataFrame, schema: str) -> DataFrame:
    """``df`` with the declared columns, in order and type; a missing column or a value that does not fit is an error."""
    declared = [c.split() for c in schema.split(", ")]
    missing = [name for name, _ in declared if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in declared])


def ensure_columns(masters: DataFrame) -> DataFrame:
    """Adds the status columns that are missing, each checked by itself."""
    for name, kind in STATUS_COLUMNS.items():
        if name not in masters.columns:
            masters = masters.withColumn(name, F.lit("old" if name == "record_type" else None).cast(kind))
    return masters


def reset_run(masters: DataFrame) -> DataFrame:
    """Without minted records and statuses of an earlier run."""
    kept = ensure_columns(masters).where("record_type IS NULL OR record_type <> 'new'")
    for name in ("duplicate_status", "duplicate_of", "duplicate_score", "ai_decision"):
        kept = kept.withColumn(name, F.lit(None).cast(STATUS_COLUMNS[name]))
    return kept


def write_result(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Full overwrite."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append_audit(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def run_audit(masters: DataFrame, mode: str, notes: str = "") -> DataFrame:
    """One row of run figures from a table with statuses."""
    if mode not in ("dry_run", "apply"):
        raise ValueError("mode is dry_run or apply")
    status = F.col("duplicate_status")
    groups = F.count_distinct(F.when(status == "duplicate", F.col("duplicate_of")))
    return masters.agg(
        F.expr("uuid()").alias("run_id"),
        F.current_timestamp().alias("executed_at"),
        F.lit(mode).alias("mode"),
        F.count("*").alias("total_company_rows"),
        groups.alias("duplicate_groups"),
        F.sum((status == "duplicate").cast("long")).alias("duplicate_rows"),
        F.sum((status == "probable").cast("long")).alias("probable_rows"),
        F.lit(notes).alias("notes"),
    )
