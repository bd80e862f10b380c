"""Deleting rows under the reference actions: cascade, set to NULL, restrict."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.operators.skew import lookup_side
from caudal.schemas import REFERENCES, TABLES, Reference
from caudal.session import materialise

BLOCKER_COLUMNS = ("clave", "tabla", "columna", "filas")


class Deletion(NamedTuple):
    tables: dict[str, DataFrame]
    blockers: DataFrame


class Step(NamedTuple):
    """One reference met by a deletion: the parent ids that go, and the child rows that point at them."""

    ref: Reference
    parents: DataFrame
    children: DataFrame


def _reached(tables: Mapping[str, DataFrame], table: str, doomed: DataFrame) -> Iterator[Step]:
    """The references met when ``doomed`` rows ``(clave, id)`` of ``table`` go, cascades followed.

    The walk is over the schema, not over rows.
    """
    for ref in REFERENCES:
        if ref.parent != table:
            continue
        child_key = TABLES[ref.child].key
        children = tables[ref.child].select(F.col(child_key).alias("child"), F.col(ref.column).alias("id"))
        hit = children.join(lookup_side(doomed), "id").select("clave", F.col("child").alias("id"))
        yield Step(ref, doomed, hit)
        if ref.on_delete == "CASCADE":
            yield from _reached(tables, ref.child, hit)


def _named(table: str, keys: DataFrame) -> DataFrame:
    key = TABLES[table].key
    return keys.select(F.col(key).alias("clave"), F.col(key).alias("id")).distinct()


def delete_blockers(tables: Mapping[str, DataFrame], table: str, keys: DataFrame) -> DataFrame:
    """Keys that may not go, and the rows that hold them: ``(clave, tabla, columna, filas)``."""
    found = [
        step.children.groupBy("clave")
        .agg(F.count(F.lit(1)).alias("filas"))
        .select("clave", F.lit(step.ref.child).alias("tabla"), F.lit(step.ref.column).alias("columna"), "filas")
        for step in _reached(tables, table, _named(table, keys))
        if step.ref.on_delete == "RESTRICT"
    ]
    if found:
        return reduce(DataFrame.unionByName, found)
    return (
        _named(table, keys)
        .where(F.lit(False))
        .select("clave", F.lit("").alias("tabla"), F.lit("").alias("columna"), F.lit(0).cast("long").alias("filas"))
    )


def delete_rows(tables: Mapping[str, DataFrame], table: str, keys: DataFrame) -> Deletion:
    """Delete the keys nothing restricts, with what follows from it. Blocked keys stay, and are listed."""
    # Both are read again for every table that follows: stored once.
    blockers = materialise(delete_blockers(tables, table, keys))
    doomed = materialise(_named(table, keys).join(blockers.select("clave").distinct(), "clave", "left_anti"))
    changed = dict(tables)

    def drop(name: str, ids: DataFrame) -> None:
        key = TABLES[name].key
        table_now = changed[name]
        gone = ids.select(F.col("id").alias(key)).distinct()
        changed[name] = table_now.join(gone, key, "left_anti").select(*table_now.columns)

    def set_null(ref: Reference, ids: DataFrame) -> None:
        child = changed[ref.child]
        gone = ids.select(F.col("id").alias(ref.column)).distinct().withColumn("_gone", F.lit(True))
        kept = F.when(F.col("_gone").isNull(), F.col(ref.column)).alias(ref.column)
        changed[ref.child] = child.join(lookup_side(gone), ref.column, "left").select(
            *(kept if c == ref.column else c for c in child.columns)
        )

    drop(table, doomed)
    for step in _reached(tables, table, doomed):
        if step.ref.on_delete == "CASCADE":
            drop(step.ref.child, step.children)
        elif step.ref.on_delete == "SET NULL":
            set_null(step.ref, step.parents)
    return Deletion(changed, blockers)
