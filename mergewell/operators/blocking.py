"""Block keys and candidate pairs.

Keys are functions of the normalised name, so pairs are made between distinct names, which carry how
many records have them; names shared by a third of all records are one row.  Blocks are joined on
their key, and a block over its limit is left out before the join, so a pair list is bounded by blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..plans.profiles import Profile


def block_keys(norm: Column, profile: Profile) -> Column:
    """Array of ``(strategy, key)``; keys of different strategies never meet."""

    def key(strategy: str, value: Column) -> Column:
        return F.struct(F.lit(strategy).alias("strategy"), value.alias("key"))

    n = F.char_length(norm)
    signature = T.token_signature(norm, profile.stopwords)
    usable = F.size(F.split(signature, " ")) > 1
    if profile.strict_signature:
        usable = usable & (F.char_length(signature) >= 4)
    keys = [F.when(n >= k, key(f"prefix{k}", F.substring(norm, 1, k))) for k in profile.prefixes]
    keys.append(F.when((signature != "") & usable, key("signature", signature)))
    out = F.array(*keys)
    if profile.word_blocks:
        long = T.significant(norm, profile.stopwords, 2)
        first = F.get(long, F.lit(0))
        one = F.array(
            F.when(F.size(long) > 0, key("first", first)),
            F.when(F.size(long) > 1, key("compound", F.concat(first, F.lit("_"), F.substring(F.get(long, F.lit(1)), 1, 3)))),
        )
        some = F.transform(F.filter(long, lambda w: F.char_length(w) > 4), lambda w: key("word5", F.substring(w, 1, 5)))
        out = F.concat(out, one, some)
    return F.array_distinct(F.filter(out, lambda k: k.isNotNull()))


def names_of(records: DataFrame) -> DataFrame:
    """Distinct names with their number of records, least and greatest id: ``norm, n, low, high``."""
    return records.where("norm <> ''").groupBy("norm").agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"))


def block_members(names: DataFrame, profile: Profile) -> DataFrame:
    return names.withColumn("k", F.explode(block_keys(F.col("norm"), profile))).select("norm", "n", "low", "high", "k.strategy", "k.key")


def block_sizes(members: DataFrame) -> DataFrame:
    return members.groupBy("strategy", "key").agg(F.sum("n").alias("size"))


def usable_members(names: DataFrame, profile: Profile) -> DataFrame:
    """Members of blocks of 2 to ``max_block`` records."""
    members = block_members(names, profile)
    sizes = block_sizes(members).where((F.col("size") >= 2) & (F.col("size") <= profile.max_block))
    return members.join(sizes, ["strategy", "key"]).drop("size")


def least_length_share(profile: Profile) -> float:
    """Names whose lengths differ by more can't reach the threshold.

    Two of the four ratios are at most twice the shorter length over both, the others at most 1.
    """
    tsr, tse, rat, par = profile.weights
    bound = (profile.threshold - tse - par) / (tsr + rat)  # needed of 2 * short / (short + long)
    return max(0.0, bound / (2 - bound)) - 1e-9


def candidate_pairs(members: DataFrame, profile: Profile, prune: bool = True) -> DataFrame:
    """Distinct pairs of names that share a block: ``a, b, ab, ba`` with ``a < b``."""
    side = members.select("strategy", "key", "norm", "low", "high")
    left = side.select("strategy", "key", F.col("norm").alias("a"), F.col("low").alias("a_low"), F.col("high").alias("a_high"))
    right = side.select("strategy", "key", F.col("norm").alias("b"), F.col("low").alias("b_low"), F.col("high").alias("b_high"))
    pairs = left.join(right, ["strategy", "key"]).where("a < b")
    if prune:
        short, long = F.least(F.char_length("a"), F.char_length("b")), F.greatest(F.char_length("a"), F.char_length("b"))
        pairs = pairs.where(short >= long * F.lit(least_length_share(profile)))
    pairs = pairs.select("a", "b", "a_low", "b_low", (F.col("a_low") < F.col("b_high")).alias("ab"), (F.col("b_low") < F.col("a_high")).alias("ba"))
    # Dealt by pair into all shuffle partitions, since scoring costs far more than its bytes suggest.
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pairs.repartition(parts, "a", "b").distinct()
