"""Groups of things that links hold together, by contraction of the link table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from caudal.operators.skew import lookup_side
from caudal.session import materialise

MEMBER, GROUP = "miembro", "grupo"

# So few links are joined up by one task: a round over them would take longer.
FEW_LINKS = 50_000


def _stored(edges: DataFrame) -> tuple[DataFrame, int]:
    """The links, written, and how many there are."""
    watch = Observation()
    return materialise(edges.observe(watch, F.count(F.lit(1)).alias("n"))), watch.get["n"]


def _joiner() -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The group of every name in few links, by union and find. A local function, so that executors need no package."""

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parent: dict = {}

        def root(name):
            while (up := parent.setdefault(name, name)) != name:
                parent[name] = parent[up]
                name = up
            return name

        for batch in batches:
            for u, v in zip(batch["u"].tolist(), batch["v"].tolist()):
                parent[root(u)] = root(v)
        yield pd.DataFrame([(name, root(name)) for name in list(parent)], columns=["u", "to"])

    return join


def linked_groups(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(miembro, grupo)`` for every name with a link to another: names have the same group exactly when a path of links
    joins them. A group bears the name of one of its members.

    Each round gives every name the one that comes first in a random order, redrawn for the round, among itself and its
    neighbours. Names that were given the same are one from then on, and what linked them is gone. The
    links left shrink by a constant share a round, whatever the shape: rounds grow with the logarithm of the names.
    Links with a null, or of a name with itself, count for nothing. A name with many links costs a few rows, as
    minima are taken before the shuffle. Rounds are written to the shared folder; once ``FEW_LINKS`` are left, one task joins them up.
    """
    pair = links.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))
    edges, left = _stored(pair.where(F.col(a) != F.col(b)).distinct())
    steps: list[DataFrame] = []
    while left > FEW_LINKS:
        turn = F.lit(len(steps))
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        first = both.groupBy("u").agg(F.min(F.struct(F.xxhash64("v", turn).alias("h"), F.col("v"))).alias("m"))
        own = F.struct(F.xxhash64("u", turn).alias("h"), F.col("u").alias("v"))
        steps.append(materialise(first.select("u", F.least("m", own)["v"].alias("to"))))
        name = lookup_side(steps[-1])
        moved = edges.join(name, "u").select(F.col("to").alias("a"), F.col("v").alias("u")).join(name, "u").select("a", F.col("to").alias("b"))
        edges, left = _stored(moved.where("a != b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct())
    if left or not steps:
        steps.append(edges.coalesce(1).mapInPandas(_joiner(), "u {0}, to {0}".format(edges.schema["u"].dataType.simpleString())))
    # The last round first: a name's group is that of the name it was given.
    groups = steps.pop()
    while steps:
        later = groups.select(F.col("u").alias("to"), F.col("to").alias("last"))
        groups = steps.pop().join(lookup_side(later), "to", "left").select("u", F.coalesce("last", "to").alias("to"))
    return groups.select(F.col("u").alias(MEMBER), F.col("to").alias(GROUP))
