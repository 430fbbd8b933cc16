"""Table access and text helpers of the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import sys
import zlib
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import drop_materialized, free_name, materialize, shared_dir

__all__ = ["drop_materialized", "forget", "free_name", "id_remainder", "lean", "materialize", "packed", "partitions_for", "remembered", "salted_join", "shared_dir", "stable_hash", "table", "whole_texts"]

#: Parts into which a key's rows are dealt before a join.
SALTS = 32


#: What a worker keeps between its tasks.
_remembered: dict[str, Any] = {}


def remembered(name: str, make: Callable[[], Any]) -> Any:
    """The worker's object of that name, made when a task first asks for it."""
    if name not in _remembered:
        _remembered[name] = make()
    return _remembered[name]


def forget() -> None:
    """Gives back what tasks of other operators left in this worker, which Spark hands on from stage to stage."""
    if _remembered:
        _remembered.clear()
        gc.collect()
        _trim()


def _trim() -> None:
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def _give_back() -> None:
    """Returns to the system what this worker has freed, which its allocators would keep from task to task."""
    pa.default_memory_pool().release_unused()
    _trim()


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` in a worker that gives its freed memory back before and after, and what other operators left in it."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        _give_back()
        yield from run(batches)
        _give_back()

    return task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with null texts as empty ones; extra columns go, so none can clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def packed(docs: DataFrame, *more: Column) -> DataFrame:
    """Each row of ``docs`` as the struct ``row`` beside other columns, so that no name can clash; ``row.*`` unpacks it."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *more)


def id_remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def partitions_for(df: DataFrame, least: int = 0) -> int:
    """Shuffle partitions of the session, at least ``least``."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), least)


def stable_hash(data: bytes) -> int:
    return zlib.crc32(data)


def salted_join(many: DataFrame, few: DataFrame, on: list[str], spread: list[str], how: str = "inner", salts: int = SALTS) -> DataFrame:
    """``many.join(few, on, how)`` with each key's rows on the left dealt to ``salts`` tasks by a hash of ``spread``.

    ``few`` has little for each key, since it is repeated ``salts`` times; ``how`` is inner or left.  A hash
    of the row, unlike a random number, deals a row alike when a lost task runs again.
    """
    salt = free_name("salt", many, few)
    left = many.withColumn(salt, F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    right = few.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, salt], how).drop(salt)
