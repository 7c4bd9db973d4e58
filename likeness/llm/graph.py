"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from likeness.llm.common import materialize


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Large star: every larger neighbour of u is linked to the least of u and
    its neighbours.  Small star: the same for u and its smaller neighbours."""
    both = edges.select("u", "v") if small else edges.select("u", "v").union(edges.select("v", "u"))
    # small: u > v holds for every edge, so v are the smaller neighbours
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m"))
    met = both.join(least, "u")
    linked = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if not small else (
        met.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))))
    return linked.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(id, component) of every vertex with an edge to another one;
    ``component`` is the least id reachable.

    Each round is two group-bys and two joins over the remaining edges, written
    to the checkpoint folder; the number of rounds grows with the logarithm of
    the longest chain.  Minimum aggregates combine map-side, and a vertex with
    very many edges is split by the adaptive skew join.  Nothing but two
    numbers per round reaches the driver.
    """
    now = materialize(
        edges.where(F.col(u) != F.col(v)).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(),
        "edges")
    mark = _mark(now)
    while mark[0]:
        now = materialize(_star(_star(now, small=False), small=True), "edges")
        old, mark = mark, _mark(now)
        if old == mark:
            break
    least = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return least.union(least.select("component", "component").distinct())


def _mark(edges: DataFrame) -> tuple:
    """Count and an order-free digest: equal for equal edge sets."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
