"""Flagging of arriving records: the same native stages on an unbounded table.

A record is cleaned, flagged and normalised without state, so a stream needs no watermark; grouping is
a batch job over what has been written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.pipelines import flagged_records
from ..plans.profiles import BALANCED, Profile

SCHEMA = "id long, label string, type string"


def arriving(spark: SparkSession, path: str, files_at_once: int = 1000) -> DataFrame:
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_at_once).parquet(path)


def flag_stream(records: DataFrame, out: str, checkpoint: str, profile: Profile = BALANCED) -> StreamingQuery:
    """Appends flagged records to ``out``; takes what is there, then stops."""
    writer = flagged_records(records, profile).writeStream.format("parquet").outputMode("append")
    return writer.option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
