"""Parquet and CSV layers, named bundles of tables, and the column contract that gates a write."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caudal.schemas import TABLES

PARALLEL_WRITES = 4


class ContractError(ValueError):
    """A frame does not have the columns its consumer was promised."""


def join_path(root: str, *parts: str) -> str:
    return "/".join([str(root).rstrip("/"), *parts])


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


# Quotes are doubled, and spaces around a value are kept.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite").options(**CSV_OPTIONS)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What ``write_csv`` wrote. NULL is written as nothing, so an empty text reads back as NULL."""
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)


def read_bundle(spark: SparkSession, root: str, names: Mapping[str, str] | Iterable[str]) -> dict[str, DataFrame]:
    """``{alias: frame}`` of the tables under ``root``. A missing table raises ``AnalysisException``."""
    paths = dict(names) if isinstance(names, Mapping) else {n: n for n in names}
    return {alias: spark.read.parquet(join_path(root, name)) for alias, name in paths.items()}


def write_bundle(frames: Mapping[str, DataFrame], root: str, prefix: str = "") -> None:
    """Write every frame to ``root/<prefix><name>``; a few writes run at once to keep executors busy."""
    with ThreadPoolExecutor(PARALLEL_WRITES) as pool:
        jobs = [
            pool.submit(write_parquet, df, join_path(root, f"{prefix}{name}")) for name, df in frames.items()
        ]
        for job in jobs:
            job.result()


def write_facts(frames: Mapping[str, DataFrame], gold_root: str) -> None:
    """Write a bundle to Gold as ``fact_<name>``."""
    write_bundle(frames, gold_root, prefix="fact_")


def check_contract(df: DataFrame, expected: T.StructType | Sequence[str]) -> None:
    """Names in order (and types, when a schema is given) must match. Looks at the plan only: no job."""
    if isinstance(expected, T.StructType):
        actual = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
        wanted = [(f.name, f.dataType.simpleString()) for f in expected.fields]
    else:
        actual, wanted = list(df.columns), list(expected)
    if actual != wanted:
        missing = [w for w in wanted if w not in actual]
        extra = [a for a in actual if a not in wanted]
        raise ContractError(f"columns differ: missing {missing}, unexpected {extra}, got {actual}")


def conform(df: DataFrame, table: str) -> DataFrame:
    """Cast a source frame to the table's declared columns; a column it lacks raises."""
    schema = TABLES[table].schema
    absent = [f.name for f in schema.fields if f.name not in df.columns]
    if absent:
        raise ContractError(f"{table} lacks {absent}")
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))


def with_defaults(df: DataFrame, table: str) -> DataFrame:
    """Fill the table's default values on rows to append; columns the batch lacks are added."""
    spec = TABLES[table]
    columns = []
    for f in spec.schema.fields:
        value = F.col(f.name) if f.name in df.columns else F.lit(None)
        if f.name in spec.defaults:
            default = spec.defaults[f.name]
            value = F.coalesce(value, F.current_timestamp() if default == "now" else F.lit(default))
        columns.append(value.cast(f.dataType).alias(f.name))
    return df.select(*columns)


def snapshot(frames: Mapping[str, DataFrame], root: str, at: datetime | None = None) -> str:
    """Export every table under ``root/backup/<yyyyMMdd_HHmmss>/`` and return that folder."""
    folder = join_path(root, "backup", f"{at or datetime.now():%Y%m%d_%H%M%S}")
    write_bundle(frames, folder)
    return folder


def preview(df: DataFrame, order_by: Sequence[str], rows: int = 20) -> DataFrame:
    """The first ``rows`` rows in a stable order."""
    return df.orderBy(*order_by).limit(rows)
