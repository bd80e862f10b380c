"""What changed between two states of a table, and how to bring the older one up to the newer.

Rows are compared by digests, so wide rows never meet: first digests added up by bucket of the key, in any order
of rows, then, in the buckets that differ only, key and digest row by row. The rows themselves are read last, and only those that change move.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudal.operators.skew import lookup_side
from caudal.session import materialise

INSERT, UPDATE, DELETE = "alta", "cambio", "baja"
CHANGE = "operacion"
BUCKETS = 4096


class Changes(NamedTuple):
    """Keys with what happens to them, in ``operacion``, and the new rows of those that are not deleted."""

    keys: DataFrame
    rows: DataFrame


def row_digest(columns: Sequence[str], seed: int = 0) -> Column:
    """64 bits of the whole row. A NULL counts as such: the hash function alone would pass it over."""
    parts = [part for c in sorted(columns) for part in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(F.lit(seed), *parts)


def _digested(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(BUCKETS)).alias("_bucket")
    return df.select(F.col(key).alias("_key"), bucket, row_digest(columns, 1).alias("_d1"), row_digest(columns, 2).alias("_d2"))


def _by_bucket(digests: DataFrame) -> DataFrame:
    """Rows and added digests of each bucket: the same for the same rows in any order."""
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    return digests.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"), total("_d1").alias("s1"), total("_d2").alias("s2"))


def compare(old: DataFrame, new: DataFrame, key: str) -> Changes:
    """Rows of ``new`` that ``old`` lacks or has otherwise, and keys of ``old`` that ``new`` lacks.

    ``key`` is unique in each and names the row; a NULL key is a key like others. Columns are those of ``old``, and a column
    that ``new`` lacks is an error. Buckets whose digests agree are not looked into: two states that differ in
    few keys cost two scans and a sum of at most ``BUCKETS`` rows a task.
    """
    before, after = (_digested(df, key, old.columns) for df in (old, new))
    sums = _by_bucket(before).join(_by_bucket(after).toDF("_bucket", "m", "t1", "t2"), "_bucket", "full")
    same = F.col("n").eqNullSafe(F.col("m")) & F.col("s1").eqNullSafe(F.col("t1")) & F.col("s2").eqNullSafe(F.col("t2"))
    differing = F.broadcast(materialise(sums.where(~same).select("_bucket")))  # at most ``BUCKETS`` rows
    left = before.join(differing, "_bucket", "left_semi").select(F.col("_key").alias("k"), "_d1", "_d2", F.lit(True).alias("was"))
    right = after.join(differing, "_bucket", "left_semi").select(F.col("_key").alias("l"), F.col("_d1").alias("e1"), F.col("_d2").alias("e2"), F.lit(True).alias("is"))
    both = left.join(right, F.col("k").eqNullSafe(F.col("l")), "full")
    what = F.when(F.col("was").isNull(), INSERT).when(F.col("is").isNull(), DELETE).otherwise(UPDATE)
    other = F.col("was").isNull() | F.col("is").isNull() | (F.col("_d1") != F.col("e1")) | (F.col("_d2") != F.col("e2"))
    keys = materialise(both.where(other).select(F.when(F.col("is").isNull(), F.col("k")).otherwise(F.col("l")).alias(key), what.alias(CHANGE)))
    wanted = keys.where(F.col(CHANGE) != DELETE).select(F.col(key).alias("_key"))
    return Changes(keys, new.select(*old.columns).join(lookup_side(wanted), F.col(key).eqNullSafe(F.col("_key")), "left_semi"))


def apply_changes(old: DataFrame, changes: Changes, key: str) -> DataFrame:
    """``old`` brought up to date."""
    gone = changes.keys.where(F.col(CHANGE) != INSERT).select(F.col(key).alias("_key"))
    kept = old.join(lookup_side(gone), F.col(key).eqNullSafe(F.col("_key")), "left_anti")
    return kept.unionByName(changes.rows)
