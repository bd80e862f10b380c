"""Gold layer: KPI tables and the four management reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.functions.money import mean, money_text


def kpi_capital(cuentas: DataFrame) -> DataFrame:
    totals = cuentas.agg(F.sum("saldo").alias("total_capital"), F.count("saldo").alias("n"))
    return totals.select(
        "total_capital",
        mean(F.col("total_capital"), F.col("n")).alias("saldo_promedio"),
        F.col("total_capital").alias("descripcion"),
    )


def kpi_movimientos(transacciones: DataFrame) -> DataFrame:
    """Count and amount by month and movement type. Needs no owner, so any frame with the transaction
    columns will do; the aggregate is partial on the map side and its result is months × types rows."""
    return (
        transacciones.groupBy(
            F.date_format("fecha_transaccion", "yyyy-MM").alias("periodo"),
            "tipo_movimiento",
        )
        .agg(F.count("id_transaccion").alias("movimientos"), F.sum("monto").alias("monto_total"))
        .orderBy("periodo", "tipo_movimiento")
    )


def kpi_prestamos(prestamos: DataFrame) -> DataFrame:
    by_state = prestamos.groupBy("estado").agg(
        F.count("id_prestamo").alias("total_creditos"),
        F.sum("monto").alias("monto_total_colocado"),
        F.count("monto").alias("n"),
    )
    return by_state.select(
        "estado",
        "total_creditos",
        "monto_total_colocado",
        mean(F.col("monto_total_colocado"), F.col("n")).alias("ticket_promedio_prestamo"),
    )


def gold_tables(silver: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "kpi_capital": kpi_capital(silver["dim_cuentas"]),
        "kpi_movimientos": kpi_movimientos(silver["dim_fact_transacciones"]),
        "kpi_prestamos": kpi_prestamos(silver["dim_fact_prestamos"]),
    }


def report_total_capital(cuenta: DataFrame) -> DataFrame:
    total = cuenta.agg(F.sum("saldo").alias("total_capital"))
    return total.select("total_capital", money_text(F.col("total_capital"), 15).alias("texto"))


def report_average_transaction(transaccion: DataFrame) -> DataFrame:
    sums = transaccion.agg(F.sum("monto").alias("s"), F.count("monto").alias("n"))
    average = mean(F.col("s"), F.col("n"))
    shown = F.round((F.col("s") / F.nullif(F.col("n"), F.lit(0).cast("long"))), 2)
    return sums.select(average.alias("monto_promedio"), money_text(shown, 12).alias("texto"))


def report_top_delegaciones(cliente: DataFrame, top: int = 3) -> DataFrame:
    return (
        cliente.groupBy("delegacion")
        .agg(F.count(F.lit(1)).alias("total"))
        .orderBy(F.desc("total"), F.asc("delegacion"))
        .limit(top)
    )


def report_movement_mix(transaccion: DataFrame) -> DataFrame:
    return (
        transaccion.groupBy("tipo_movimiento")
        .agg(F.count(F.lit(1)).alias("total"))
        .orderBy(F.desc("total"), F.asc("tipo_movimiento"))
    )


def management_reports(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "Total de capital": report_total_capital(tables["cuenta"]),
        "Monto promedio por transacción": report_average_transaction(tables["transaccion"]),
        "Delegaciones con más clientes": report_top_delegaciones(tables["cliente"]),
        "Movimientos por tipo": report_movement_mix(tables["transaccion"]),
    }
