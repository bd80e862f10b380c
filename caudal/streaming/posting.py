"""Authorise and post transactions as they arrive, in micro-batches.

Folders under the state root, each overwritten whole when a batch is retried:

* ``balances/version=<v>``: every account after batch ``v`` (``-1`` is the opening);
* ``changes/batch=<b>``: what batch ``b`` changed, by account;
* ``decisions/batch=<b>``: the batch's transactions, accepted or refused with the reason.

A batch reads the latest full version and the changes since, and writes only
what it changes; a full version is written every ``compact_every`` batches. Versions follow from the batch number alone: a retry reads
exactly what the first try read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from caudal.operators.ledger import accepted, apply_change, authorize, movements, net_change
from caudal.schemas import TABLES
from caudal.session import materialise
from caudal.sources.files import join_path, write_parquet

CHANGE_SCHEMA = T.StructType(
    [T.StructField("no_cuenta", T.StringType()), T.StructField("cambio", T.DecimalType(38, 2))]
)


@dataclass(frozen=True)
class LedgerState:
    spark: SparkSession
    root: str
    compact_every: int = 16

    def _version(self, v: int) -> str:
        return join_path(self.root, "balances", f"version={v}")

    def _changes(self, b: int) -> str:
        return join_path(self.root, "changes", f"batch={b}")

    def _base(self, batch: int) -> int:
        """The newest full version a batch may build on."""
        return batch // self.compact_every * self.compact_every - 1

    def open(self, cuenta: DataFrame) -> None:
        write_parquet(cuenta.select(*TABLES["cuenta"].schema.fieldNames()), self._version(-1))

    def _balances(self, base: int, batches: range) -> DataFrame:
        cuenta = self.spark.read.schema(TABLES["cuenta"].schema).parquet(self._version(base))
        if not batches:
            return cuenta
        changes = self.spark.read.schema(CHANGE_SCHEMA).parquet(*(self._changes(b) for b in batches))
        return apply_change(cuenta, changes.groupBy("no_cuenta").agg(F.sum("cambio").alias("cambio")))

    def balances_before(self, batch: int) -> DataFrame:
        base = self._base(batch)
        return self._balances(base, range(base + 1, batch))

    def balances_after(self, batch: int) -> DataFrame:
        base = self._base(batch)
        return self._balances(base, range(base + 1, batch + 1))

    def apply(self, arrived: DataFrame, batch: int, mode: str) -> None:
        arrived = materialise(movements(arrived))
        decisions = join_path(self.root, "decisions", f"batch={batch}")
        write_parquet(authorize(arrived, self.balances_before(batch), mode), decisions)
        passed = accepted(self.spark.read.parquet(decisions))
        change = net_change(passed).select("no_cuenta", F.col("cambio").cast("decimal(38,2)").alias("cambio"))
        write_parquet(change, self._changes(batch))
        if (batch + 1) % self.compact_every == 0:
            write_parquet(self.balances_after(batch), self._version(batch))

    def decisions(self) -> DataFrame:
        return self.spark.read.parquet(join_path(self.root, "decisions"))


def stream_postings(
    spark: SparkSession,
    arrivals: str,
    state: LedgerState,
    mode: str = "serial",
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start the query over the Parquet files that arrive in ``arrivals``; it stops when it has read
    what is there, and goes on from its checkpoint when started again.

    Files are taken in order of arrival, rows within a batch in id order.
    """
    reader = spark.readStream.schema(TABLES["transaccion"].schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (
        reader.parquet(arrivals)
        .writeStream.foreachBatch(lambda arrived, batch: state.apply(arrived, batch, mode))
        .option("checkpointLocation", join_path(state.root, "_checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
