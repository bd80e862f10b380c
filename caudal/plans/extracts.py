"""The two extract runs: read Silver, widen, check the columns, write CSV to Gold."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from caudal.operators.extracts import (
    TILE,
    TILED_COLUMNS,
    WIDE_COLUMNS,
    tiled_transactions,
    wide_transactions,
)
from caudal.plans.lakehouse import Lake
from caudal.sources.files import check_contract, join_path, read_bundle, write_csv

BUNDLE = {
    "clientes": "dim_clientes",
    "cuentas": "dim_cuentas",
    "tarjetas": "dim_tarjetas",
    "prestamos": "dim_fact_prestamos",
    "transacciones": "dim_fact_transacciones",
    "beneficiarios": "dim_beneficiarios",
}


def bundle(silver: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Silver tables under the names the extracts use."""
    return {alias: silver[name] for alias, name in BUNDLE.items()}


def extract_wide(lake: Lake, card_key: str = "no_cuenta", files: int | None = None) -> str:
    """Write ``dataset_final``; ``files`` fixes the number of CSV files."""
    wide = wide_transactions(read_bundle(lake.spark, lake.silver_root, BUNDLE), card_key, files)
    check_contract(wide, WIDE_COLUMNS)
    path = join_path(lake.gold_root, "dataset_final")
    write_csv(wide, path)
    return path


def extract_tiles(lake: Lake, tiles: int = 4, card_key: str = "no_cuenta") -> str:
    """Write ``golden_dataset``, one folder per tile, in one pass."""
    tiled = tiled_transactions(read_bundle(lake.spark, lake.silver_root, BUNDLE), tiles, card_key)
    check_contract(tiled, TILED_COLUMNS)
    path = join_path(lake.gold_root, "golden_dataset")
    write_csv(tiled, path, [TILE])
    return path
