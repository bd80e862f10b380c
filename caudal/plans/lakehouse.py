"""The layered run: source tables to Bronze, Bronze to Silver, Silver to Gold."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.operators.changes import apply_changes, compare
from caudal.operators.gold import gold_tables
from caudal.operators.silver import SILVER_TABLES, silver_tables
from caudal.schemas import TABLES
from caudal.session import materialise
from caudal.sources.files import conform, join_path, read_bundle, read_parquet, write_bundle, write_parquet

PERIOD = "periodo"


@dataclass(frozen=True)
class Lake:
    """One root folder with its three layers."""

    spark: SparkSession
    root: str

    @property
    def bronze_root(self) -> str:
        return join_path(self.root, "bronze")

    @property
    def silver_root(self) -> str:
        return join_path(self.root, "silver")

    @property
    def gold_root(self) -> str:
        return join_path(self.root, "gold")

    def bronze(self) -> dict[str, DataFrame]:
        return {
            name: read_parquet(self.spark, join_path(self.bronze_root, f"{name}.parquet"), table.schema)
            for name, table in TABLES.items()
        }

    def silver(self) -> dict[str, DataFrame]:
        return read_bundle(self.spark, self.silver_root, SILVER_TABLES)

    def gold(self, name: str) -> DataFrame:
        return self.spark.read.parquet(join_path(self.gold_root, name))

    def ingest(self, read_table: Callable[[str], DataFrame]) -> None:
        """Write all nine tables to Bronze, in the declared types. ``read_table`` names the source: a JDBC
        reader's, or any function from table name to frame."""
        frames = {f"{name}.parquet": conform(read_table(name), name) for name in TABLES}
        write_bundle(frames, self.bronze_root)

    def sync(self, read_table: Callable[[str], DataFrame], tables: Iterable[str] = tuple(TABLES)) -> dict[str, DataFrame]:
        """Bring Bronze tables up to the source's state: ``{table: keys with their operation}`` of those that had changes.
        A table without any is not written."""
        done = {}
        for name in tables:
            path, key = join_path(self.bronze_root, f"{name}.parquet"), TABLES[name].key
            old = read_parquet(self.spark, path, TABLES[name].schema)
            changes = compare(old, conform(read_table(name), name), key)
            if not changes.keys.isEmpty():
                done[name] = changes.keys
                # Written aside first: a table cannot be overwritten while it is read.
                write_parquet(materialise(apply_changes(old, changes, key)), path)
        return done

    def refine(self, mask_cards: bool = False, partition_fact: bool = False) -> None:
        """Bronze to Silver. ``partition_fact`` lays the transactions out by month for readers that ask
        for some months only."""
        frames = silver_tables(self.bronze(), mask_cards)
        if partition_fact:
            fact = frames.pop("dim_fact_transacciones")
            # Rows of a month meet in few tasks, so few files; a large month is split.
            by_month = fact.withColumn(PERIOD, F.date_format("fecha_transaccion", "yyyy-MM")).hint("rebalance", PERIOD)
            write_parquet(by_month, join_path(self.silver_root, "dim_fact_transacciones"), [PERIOD])
        write_bundle(frames, self.silver_root)

    def publish(self) -> None:
        """Silver to the Gold KPI tables."""
        write_bundle(gold_tables(self.silver()), self.gold_root)

    def bronze_counts(self) -> DataFrame:
        """``(tabla, filas)`` of what Bronze holds; Parquet answers from its footers."""
        counts = [
            df.agg(F.count(F.lit(1)).alias("filas")).select(F.lit(name).alias("tabla"), "filas")
            for name, df in self.bronze().items()
        ]
        every = counts[0]
        for one in counts[1:]:
            every = every.unionByName(one)
        return every


def run(spark: SparkSession, root: str, read_table: Callable[[str], DataFrame], **refine: bool) -> Lake:
    lake = Lake(spark, root)
    lake.ingest(read_table)
    lake.refine(**refine)
    lake.publish()
    return lake
