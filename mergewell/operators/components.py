"""Connected components by star contraction.

Each round hangs the larger neighbours of every node on its least neighbour, then the smaller ones,
until the edges are stars.  A round shuffles at most the edges and is written to the shared folder,
so the plan stays flat.  Least neighbours are found by a map-side aggregate, never by gathering a
node's neighbours, so a hub with a third of all edges is one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import drop_materialized, materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame, a: str = "id_a", b: str = "id_b", most_rounds: int = 60) -> DataFrame:
    """``(id, component)`` of every id in ``edges``; a component is named by its least id.

    Null ends and loops are no edges; a loop's id alone is not in the result.
    """
    start = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).isNotNull().alias("_x"), F.col(b).isNotNull().alias("_y"))
    now = materialize(start.where("_x and _y and u <> v").select("u", "v").distinct(), "edges")
    before = _state(now)
    for _ in range(most_rounds if before[0] else 0):
        big = materialize(_large_star(now), "edges")
        drop_materialized(now)
        now = materialize(_small_star(big), "edges")
        drop_materialized(big)
        after = _state(now)
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(now.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
