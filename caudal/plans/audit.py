"""The quality run over Bronze, and ad-hoc SQL over the tables."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from caudal.operators.quality import Tally, added, core_report, quality_report, report_of, taken_off, tally
from caudal.session import materialise
from caudal.sources.files import join_path, write_parquet

log = logging.getLogger(__name__)


def run_sql(spark: SparkSession, text: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Run SQL over the named tables."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text)


def audit(tables: Mapping[str, DataFrame], full: bool = False) -> DataFrame:
    """The rule results, stored once, with failures logged as warnings. A failure never stops the run."""
    report = materialise(quality_report(tables) if full else core_report(tables))
    failed = report.where("NOT aprobada").collect()
    for row in failed:
        log.warning("%s: %d filas", row["regla"], row["fallas"])
    log.info("%d de %d reglas fallan", len(failed), report.count())
    return report


@dataclass(frozen=True)
class QualityStore:
    """Rule tallies of the batches that have arrived, in folders under ``root``; a batch that is retried overwrites its own.

    A report reads tallies only, never the rows again. ``fold`` puts the tallies so far into one.
    """

    spark: SparkSession
    root: str

    def _folder(self, part: str, batch: int) -> str:
        return join_path(self.root, part, f"batch={batch}")

    def add(self, batch: int, arrived: Mapping[str, DataFrame], gone: Mapping[str, DataFrame] | None = None) -> None:
        """Count the rows that arrived, and take off those that went; a changed row is both. All tables must be named."""
        counted = tally(arrived)
        self._write(batch, added([counted, taken_off(tally(gone))]) if gone else counted)

    def _write(self, batch: int, t: Tally) -> None:
        write_parquet(t.rules, self._folder("rules", batch))
        write_parquet(t.keys, self._folder("keys", batch))

    def total(self, batches: range) -> Tally:
        """The tally of all rows of these batches."""
        rules, keys = (
            self.spark.read.parquet(*(self._folder(part, b) for b in batches)) for part in ("rules", "keys")
        )
        return added([Tally(rules, keys)])

    def report(self, batches: range) -> DataFrame:
        """Every rule over all rows of these batches as ``(regla, fallas, aprobada)``."""
        return report_of(self.total(batches))

    def fold(self, batches: range, into: QualityStore) -> None:
        """Write the tallies of these batches as batch 0 of another store, without values that no row has any more."""
        t = self.total(batches)
        counts = [c for c in t.keys.columns if c not in ("dominio", "valor")]
        held = " OR ".join(f"{c} <> 0" for c in counts)
        into._write(0, Tally(t.rules, t.keys.where(held)))
