"""Written intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only by a local session that names no shared folder (tests, laptops).
LOCAL_CHECKPOINTS = "file:/tmp/checkpoints/mergewell"


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, else the folder set on its context.

    Without either, a local session takes a folder of its own; a cluster is refused, since its
    executors could not read what another machine wrote there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        on_context = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = on_context.get() if on_context.isDefined() else None
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = LOCAL_CHECKPOINTS
    return named.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The written table cuts the lineage: a lost executor costs a re-read, not a re-run, and
    values made from partition numbers are fixed once.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/mergewell-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._mergewell_path = path  # type: ignore[attr-defined]
    return out


def drop_materialized(*tables: DataFrame) -> None:
    """Delete tables of :func:`materialize` that no later result reads."""
    for df in tables:
        path = getattr(df, "_mergewell_path", None)
        if path:
            where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def free_name(wanted: str, *tables: DataFrame) -> str:
    """``wanted``, lengthened until none of the tables has a column of that name, in any case of letters."""
    taken = {c.lower() for t in tables for c in t.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
