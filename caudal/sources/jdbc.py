"""Relational source: split parallel reads of the operational tables over JDBC."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession

from caudal.schemas import TABLES

DRIVER = "org.postgresql.Driver"
FETCH_ROWS = 10_000


@dataclass(frozen=True)
class JdbcSource:
    """Where the operational tables live, and how many concurrent reads each may take: a number only the caller can know."""

    url: str
    user: str = ""
    password: str = ""
    driver: str = DRIVER
    partitions: int = field(kw_only=True)

    @classmethod
    def from_database_url(cls, database_url: str, *, partitions: int) -> JdbcSource:
        parts = urlsplit(database_url or "")
        if not parts.scheme or not parts.hostname or parts.hostname == "None":
            raise ValueError("database URL needs a scheme and a host")
        if "None" in (parts.username, parts.path.lstrip("/")):
            raise ValueError("database URL was built from unset variables")
        port = f":{parts.port}" if parts.port else ""
        return cls(
            url=f"jdbc:postgresql://{parts.hostname}{port}{parts.path}",
            user=unquote(parts.username or ""),
            password=unquote(parts.password or ""),
            partitions=partitions,
        )

    @classmethod
    def from_environment(cls, default: str = "", *, partitions: int) -> JdbcSource:
        return cls.from_database_url(os.environ.get("DATABASE_URL", default), partitions=partitions)

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "fetchsize": str(FETCH_ROWS),
        }

    def bounds_query(self, table: str, column: str) -> str:
        return f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"

    def range_options(self, column: str, lower: int, upper: int) -> dict[str, str]:
        """Even stripes of a numeric key; rows outside the bounds still fall in the end stripes."""
        return {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(max(upper, lower + 1)),
            "numPartitions": str(self.partitions),
        }

    def hash_predicates(self, column: str) -> list[str]:
        """Disjoint row sets of a text key, evaluated by the database. NULL goes with the first set."""
        hashed = f"MOD(ABS(HASHTEXT({column})::BIGINT), {self.partitions})"
        return [
            f"{hashed} = {i}" if i else f"({hashed} = 0 OR {column} IS NULL)" for i in range(self.partitions)
        ]

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """The whole table, split by its key: stripes for numeric keys, hash sets for text keys."""
        spec = TABLES[table]
        options = self.options()
        if self.partitions <= 1:
            return spark.read.format("jdbc").options(**options, dbtable=table).load()
        if spec.schema[spec.key].dataType.typeName() != "long":
            url = options.pop("url")
            return spark.read.jdbc(url, table, predicates=self.hash_predicates(spec.key), properties=options)
        bounds = spark.read.format("jdbc").options(**options, query=self.bounds_query(table, spec.key)).load().first()
        if bounds is None or bounds["lo"] is None:
            return spark.read.format("jdbc").options(**options, dbtable=table).load()
        stripes = self.range_options(spec.key, bounds["lo"], bounds["hi"])
        return spark.read.format("jdbc").options(**options, **stripes, dbtable=table).load()
