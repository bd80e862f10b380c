"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.operators.skew import lookup_side
from caudal.session import materialise


# So few links are one task's work: a round over them moves nothing.
FEW_LINKS = 50_000


def _signature(edges: DataFrame) -> tuple:
    """Row count and an order-free checksum: equal when a round has changed nothing."""
    mark = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mark)).first())


def _to_minimum(rows: DataFrame, few: bool) -> DataFrame:
    """Adds to every ``(u, v)`` the smallest ``v`` of its ``u``. A hub's rows can be split over tasks, unless rows are few."""
    least = rows.groupBy("u").agg(F.min("v").alias("m"))
    return rows.join(least if few else lookup_side(least), "u")


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(id, component)``: the smallest id reachable, for every id that has a link to a smaller one.

    ``links`` holds undirected pairs of ids; pairs with a null and self links count for nothing. Ids not
    in the result are the smallest of their component or have no link. A round works on the edge list
    alone, in joins and minima by key, and rounds grow with the logarithm of the longest chain. Each
    round is written to the shared folder, so a lost executor costs one round at most. A round over at most
    ``FEW_LINKS`` links is one task.
    """
    pair = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = materialise(pair.where((F.col(a) != F.col(b))).distinct())
    seen = _signature(edges)
    while seen[0]:
        few = seen[0] <= FEW_LINKS
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        both = both.coalesce(1) if few else both
        large = (
            _to_minimum(both, few)
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        hooked = _to_minimum(large, few)
        small = hooked.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(hooked.select("u", F.col("m").alias("v")))
        edges = materialise((small.coalesce(1) if few else small).distinct())
        now = _signature(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
