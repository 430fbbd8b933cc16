"""Mixing sources to target weights, with DataFrame functions only.

The token share p of each source is raised to an exponent and normalised (temperature mixing):
1 keeps the natural shares, 0 makes all sources equal.  The exponent is bisected until the
weights have a target entropy, or until no source repeats more than a limit.  Weights become
documents by block permutations under a token budget: a keyed hash deals a source's documents
into 1024 x 1024 blocks and orders them; whole passes come first, and the rest of the budget
takes blocks in hash order, then documents of the block in which the budget ends.  Every copy has its
pass, its block in that pass and its place in the block, from a hash of its own for each pass; read by
these three, the copies of all sources are one permuted stream, which :func:`mixed_stream` writes out.

Scale: the plan reads texts where they lie and never shuffles them; sources and blocks are
pre-aggregated map-side, so a source with a third of all rows is a few rows per task.  Every window
runs over at most 1024 rows or one block.  The table of sources is broadcast only if its counted size
is under ``BROADCAST_SOURCES``; a larger one is joined with salted keys.  The stream is one range shuffle.

Defined results: null texts have no tokens; null sources form one source, ``''``; equal rows get
the same copies; a source without tokens has weight 0 and each of its rows one copy; an empty
table gives an empty result.  ``mixed`` replaces columns that clash with its own; ``planned`` and
``mixed_stream`` leave every column of the input as it is, whatever its name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_materialized, materialize, packed, salted_join

BROADCAST_SOURCES = 50_000
#: Exponents evaluated at once in a pass over the sources: 15 inner points are four halvings.
POINTS = 16
PASSES = 8


def count_tokens(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _position(seed: int, *more: Column) -> Column:
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"), *more)


def _blocks(position: Column) -> tuple[Column, Column]:
    """Upper and lower ten bits of the block; the order of blocks is the order of positions."""
    return F.shiftright(position, 54), F.shiftright(position, 44)


def bisect_exponent(sources: DataFrame, budget: float | None, target_entropy: float | None, repetition_limit: float | None) -> float:
    """The exponent in [0, 1] that meets the target; both targets are monotone in it.

    The flattest mixture (least exponent) whose entropy is no more than ``target_entropy``, or in
    which no source is read more than ``repetition_limit`` times.  Without a budget, the budget is
    the least one at which every source is read whole once.
    """
    live = sources.where("tokens > 0")
    total = live.agg(F.sum("tokens")).first()[0]
    if not total:
        return 1.0
    live = live.select((F.col("tokens") / F.lit(float(total))).alias("p"), F.col("tokens").cast("double").alias("tokens"))
    low, high = 0.0, 1.0

    def meets(points: list[float]) -> list[bool]:
        at = live.withColumn("x", F.explode(F.array(*[F.lit(x) for x in points])))
        logp = F.log("p")
        stats = at.groupBy("x").agg(
            F.sum(F.exp(F.col("x") * logp)).alias("z"),
            F.sum(F.exp(F.col("x") * logp) * F.col("x") * logp).alias("zl"),
            F.max(F.exp((F.col("x") - 1) * logp)).alias("most"),
            F.min(F.exp((F.col("x") - 1) * logp)).alias("least"),
        )
        by = {r["x"]: r for r in stats.collect()}  # one row for each of the exponents
        out = []
        for x in points:
            r = by[x]
            if target_entropy is not None:
                import math

                out.append(math.log(r["z"]) - r["zl"] / r["z"] <= target_entropy + 1e-12)
            else:
                repeats = r["most"] / r["least"] if budget is None else r["most"] * budget / (r["z"] * total)
                out.append(repeats <= repetition_limit + 1e-12)
        return out

    if meets([0.0])[0]:
        return 0.0
    for _ in range(PASSES):
        points = [low + (high - low) * i / POINTS for i in range(1, POINTS)]
        ok = meets(points)
        first = ok.index(True) if True in ok else len(points)
        low, high = (points[first - 1] if first else low), (points[first] if first < len(points) else high)
    return high


def _place(number: Column, position: Column) -> Column:
    return F.struct(number.cast("int").alias("pass"), (F.shiftright(position, 44) + F.lit(1 << 19)).cast("int").alias("block"), position.bitwiseAND(F.lit((1 << 44) - 1)).alias("place"))


def planned(docs: DataFrame, target_entropy: float | None = None, repetition_limit: float | None = None, budget: float | None = None, seed: int = 20, source: str = "source") -> DataFrame:
    """``row, mix``: each row of ``docs`` as a struct, and ``n_tokens, weight, exponent, copies, places`` of it.

    ``copies`` may be 0 under a small budget; ``places`` has ``(pass, block, place)`` for each copy.
    """
    position = _position(seed)
    upper, lower = _blocks(position)
    of = F.coalesce(F.col(source).cast("string"), F.lit("")).alias("s")
    slim = docs.select(of, upper.alias("upper"), lower.alias("lower"), count_tokens(F.col("text")).alias("t"))
    block = materialize(slim.groupBy("s", "upper", "lower").agg(F.sum("t").alias("t")), "mixblocks")
    sources = materialize(block.groupBy("s").agg(F.sum("t").alias("tokens")), "mixsources")
    few = sources.count() <= BROADCAST_SOURCES

    def meet(many: DataFrame, small: DataFrame, on: list[str], spread: list[str]) -> DataFrame:
        """``small`` has a row per source at most: it is broadcast if the counted sources are few."""
        return many.join(F.broadcast(small), on) if few else salted_join(many, small, on, spread)

    exponent = bisect_exponent(sources, budget, target_entropy, repetition_limit)
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    raised = F.when(F.col("tokens") > 0, F.exp(F.lit(exponent) * F.log(F.col("tokens") / F.lit(float(total or 1))))).otherwise(0.0)
    z, whole = sources.agg(F.sum(raised), F.max(F.when(F.col("tokens") > 0, F.col("tokens") / raised))).first()
    z = z or 1.0
    budget = budget if budget is not None else (whole or 0.0) * z
    plan = sources.withColumn("weight", raised / F.lit(float(z))).withColumn("goal", F.col("weight") * F.lit(float(budget)))
    # A goal within a token of a whole number of passes is that number.
    ratio = F.when(F.col("tokens") > 0, F.col("goal") / F.col("tokens")).otherwise(F.lit(1.0))
    plan = plan.withColumn("passes", F.floor(ratio + 1e-9)).withColumn("rest", F.greatest(F.col("goal") - F.col("passes") * F.col("tokens"), F.lit(0.0)))
    plan = plan.withColumn("rest", F.when(F.col("tokens") > 0, F.col("rest")).otherwise(0.0))
    # The block in which the rest of the budget ends: among 1024 upper blocks, then 1024 lower ones.
    first = meet(_running(block.groupBy("s", "upper").agg(F.sum("t").alias("t")), ["s"], "upper"), plan.select("s", "rest"), ["s"], ["upper"]).where("t > 0 and before <= rest and rest < before + t")
    first = first.groupBy("s").agg(F.min("upper").alias("upper"), F.min_by("before", "upper").alias("base"), F.first("rest").alias("rest"))
    first = materialize(first, "mixcut")
    second = meet(block, first, ["s", "upper"], ["lower"])
    second = _running(second, ["s"], "lower", F.first("base").alias("base"), F.first("rest").alias("rest")).where("t > 0 and base + before <= rest and rest < base + before + t")
    second = materialize(second.groupBy("s").agg(F.min("lower").alias("cut"), F.min_by(F.col("base") + F.col("before"), "lower").alias("spent"), F.first("rest").alias("rest")), "mixcut2")
    # Inside that one block, documents in order of position; equal rows stand or fall together.
    inside = meet(docs.select(of, lower.alias("cut"), position.alias("position"), count_tokens(F.col("text")).alias("t")), second, ["s", "cut"], ["position"])
    inside = inside.groupBy("s", "position").agg(F.sum("t").alias("t"), F.first("spent").alias("spent"), F.first("rest").alias("rest"))
    sofar = F.sum("t").over(Window.partitionBy("s").orderBy("position").rowsBetween(Window.unboundedPreceding, 0))
    last = inside.withColumn("sofar", sofar).where("spent + sofar <= rest").groupBy("s").agg(F.max("position").alias("last"))
    plan = plan.join(second.select("s", "cut"), "s", "left").join(last, "s", "left").select("s", "weight", "passes", "cut", "last")
    plan = materialize(plan, "mixplan")
    drop_materialized(block, sources, first, second)
    tagged = packed(docs, of, position.alias("position"), count_tokens(F.col("text")).alias("t"), F.col("doc_id"), F.col("text"))
    joined = meet(tagged, plan, ["s"], ["position"])
    cut = F.coalesce(F.col("cut"), F.lit(-(2**62)))
    at = _blocks(F.col("position"))[1]
    more = (at < cut) | F.coalesce((at == cut) & (F.col("position") <= F.col("last")), F.lit(False))
    passes = F.when(F.col("passes") > 0, F.sequence(F.lit(0), F.col("passes").cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    places = F.transform(passes, lambda k: _place(k, _position(seed, k)))
    places = F.concat(places, F.when(more, F.array(_place(F.col("passes"), F.col("position")))).otherwise(F.slice(places, 1, 0)))
    mix = F.struct(F.col("t").alias("n_tokens"), F.col("weight"), F.lit(exponent).alias("exponent"), (F.col("passes") + more.cast("long")).cast("long").alias("copies"), places.alias("places"))
    return joined.select("row", mix.alias("mix"))


def mixed(docs: DataFrame, target_entropy: float | None = None, repetition_limit: float | None = None, budget: float | None = None, seed: int = 20, source: str = "source") -> DataFrame:
    """``docs`` with ``n_tokens, weight, exponent, copies, places``, a row per row."""
    out = planned(docs, target_entropy, repetition_limit, budget, seed, source)
    own = {"n_tokens", "weight", "exponent", "copies", "places"}
    return out.select(*[F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in own], "mix.*")


def mixed_stream(docs: DataFrame, target_entropy: float | None = None, repetition_limit: float | None = None, budget: float | None = None, seed: int = 20, source: str = "source") -> DataFrame:
    """A row of ``docs`` for each copy, in the order of pass, block and place over all sources."""
    out = planned(docs, target_entropy, repetition_limit, budget, seed, source).select("row", F.explode("mix.places").alias("at"))
    return out.repartitionByRange("at.pass", "at.block", "at.place").sortWithinPartitions("at.pass", "at.block", "at.place").select("row.*")


def _running(df: DataFrame, by: list[str], order: str, *more: Column) -> DataFrame:
    """Tokens before each block; a window holds at most 1024 blocks."""
    g = df.groupBy(*by, order).agg(F.sum("t").alias("t"), *more)
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return g.withColumn("before", F.coalesce(F.sum("t").over(w), F.lit(0)))
