"""Exact duplicates by deterministic block naming.

A normalised text is cut into blocks of a fixed number of bytes.  All distinct blocks are sorted
into integer names, then adjacent names are paired and the distinct pairs are named again, until
each document holds one name.  Two texts have the same final name at the same level if and only
if they are equal: a name stands for one content, and the tree below it can be unfolded.

Scale: block contents are shuffled once, after a map-side distinct, so a hot text costs one row
per map task.  Rows then refer to a block by a 64-bit address; before an address is used, the
distinct contents are counted against the distinct addresses, and the seed moves on if two
contents share one, so no collision can pass.  Pair rounds shuffle integers only and shrink by
half each time.  Each round is a written table.

Defined results: a null text is an empty text; texts that are empty or equal after white space is
folded form one group; rows that repeat an id and a text all appear, and one of them stays; rows
with a null id are never smaller than others; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_materialized, materialize, whole_texts

BLOCK_BYTES = 4096


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def _blocks(data: Column, size: int) -> Column:
    """The blocks of a binary column; an empty text is one empty block."""
    last = F.floor(F.greatest(F.octet_length(data) - 1, F.lit(0)) / size).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(data, i * F.lit(size) + F.lit(1), F.lit(size)))


def _named(distinct: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Integer names of distinct rows: sorted inside their partition, numbered, and written."""
    return materialize(distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id()), label)


def block_names(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """``(address, name)`` of every distinct block and the seed whose addresses are free of collisions."""
    data = normalised(F.col("text")).cast("binary")
    seed = 0
    while True:
        block = docs.select(F.explode(_blocks(data, block_bytes)).alias("block"))
        block = block.select(_address(F.col("block"), seed).alias("address"), "block").distinct()
        named = materialize(block.sortWithinPartitions("address", "block").select("address", F.monotonically_increasing_id().alias("name")), "blocks")
        rows, addresses = named.agg(F.count("*"), F.count_distinct("address")).first()
        if rows == addresses:
            return named, seed
        drop_materialized(named)
        seed += 1


def _address(block: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), block)


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``, a row per row of ``docs``."""
    docs = whole_texts(docs)
    names, seed = block_names(docs, block_bytes)
    text = normalised(F.col("text"))
    keyed = docs.select("doc_id", F.unhex(F.sha2(text, 256)).alias("sha"), F.transform(_blocks(text.cast("binary"), block_bytes), lambda b: _address(b, seed)).alias("addresses"))
    # A repeated id with a repeated text is one key that counts its copies.
    keyed = materialize(keyed, "keyed")
    key = ["doc_id", "sha"]
    level = 0
    rows = keyed.select(*key, F.size("addresses").alias("n"), F.posexplode("addresses").alias("pos", "address")).join(names, "address").select(*key, "n", "pos", "name")
    rows = materialize(rows, "level")
    found = []
    while True:
        found.append(rows.where("n = 1").select(*key, F.lit(level).alias("level"), "name"))
        longer = rows.where("n > 1")
        if longer.isEmpty():
            break
        pairs = longer.groupBy(*key, F.col("n"), F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"),
        )
        pairs = materialize(pairs, "pairs")
        again = _named(pairs.select("a", "b").distinct(), ["a", "b"], "names")
        rows = materialize(pairs.join(again, ["a", "b"]).select(*key, F.ceil(F.col("n") / 2).cast("int").alias("n"), "pos", "name"), "level")
        drop_materialized(pairs)
        drop_materialized(again)
        level += 1
    one = found[0]
    for more in found[1:]:
        one = one.unionByName(more)
    one = one.dropDuplicates(key)
    copies = keyed.groupBy(*key).agg(F.count("*").alias("copies"))
    same = (F.col("o.doc_id").eqNullSafe(F.col("c.doc_id"))) & (F.col("o.sha") == F.col("c.sha"))
    one = materialize(one.alias("o").join(copies.alias("c"), same).select("o.doc_id", "o.sha", "level", "name", "copies"), "identity")
    groups = one.groupBy("level", "name").agg(F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    out = one.join(groups, ["level", "name"]).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return out.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


ORACLE = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""
