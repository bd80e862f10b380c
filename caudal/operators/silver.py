"""Silver layer: masked dimensions, facts with their owner, and the credit-model base table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudal.functions.masking import mask_card, mask_digits, mask_mail_user

SILVER_TABLES = (
    "dim_clientes",
    "dim_beneficiarios",
    "dim_cuentas",
    "dim_tarjetas",
    "dim_fact_transacciones",
    "dim_fact_prestamos",
    "pivot_model_credit",
)


def masked_phone_list(phones: DataFrame, key: str, separator: str, name: str) -> DataFrame:
    """One masked, ordered, separated phone list per key.

    Digits are masked before the shuffle. Equal masks are then counted on the map side, so an owner with
    any number of phones ships one row per distinct mask (a handful), not one per phone.
    """
    masks = (
        phones.where(F.col("tel").isNotNull())
        .groupBy(key, mask_digits(F.col("tel")).alias("mask"))
        .agg(F.count(F.lit(1)).alias("times"))
    )
    runs = F.array_sort(F.collect_list(F.struct("mask", "times")))

    def spelled(run: Column) -> Column:
        times = F.when(run["times"] <= 2**31 - 1, run["times"]).otherwise(F.raise_error(F.lit("list of phones too long")).cast("long"))
        again = F.repeat(F.concat(F.lit(separator), run["mask"]), (times - 1).cast("int"))
        return F.concat(run["mask"], again)

    return masks.groupBy(key).agg(F.array_join(F.transform(runs, spelled), separator).alias(name))


def dim_clientes(cliente: DataFrame, cliente_tel: DataFrame) -> DataFrame:
    phones = masked_phone_list(cliente_tel, "id_cliente", ",", "telefonos")
    return cliente.join(phones, "id_cliente", "left").select(
        "id_cliente",
        F.upper("nombre").alias("nombre"),
        F.upper("apellido").alias("apellido"),
        mask_mail_user(F.col("correo")).alias("correo"),
        "delegacion",
        "estado_civil",
        F.coalesce("telefonos", F.lit("")).alias("telefonos"),
    )


def dim_beneficiarios(beneficiario: DataFrame, beneficiario_tel: DataFrame) -> DataFrame:
    phones = masked_phone_list(beneficiario_tel, "id_beneficiario", ", ", "telefonos_beneficiario")
    return beneficiario.join(phones, "id_beneficiario", "left").select(
        "id_beneficiario",
        "parentesco",
        F.upper("nombre").alias("nombre"),
        F.upper("apellido").alias("apellido"),
        "porcentaje_saldo",
        "no_cuenta",
        F.coalesce("telefonos_beneficiario", F.lit("")).alias("telefonos_beneficiario"),
    )


def dim_cuentas(cuenta: DataFrame) -> DataFrame:
    return cuenta.select("no_cuenta", "tipo_cuenta", "saldo", "id_cliente")


def dim_tarjetas(tarjeta: DataFrame, mask_cards: bool = False) -> DataFrame:
    """Cards as stored. ``mask_cards`` hides the number but for its end, and the security code."""
    number = mask_card(F.col("no_tarjeta")) if mask_cards else F.col("no_tarjeta")
    code = mask_digits(F.col("cvv")) if mask_cards else F.col("cvv")
    return tarjeta.select(number.alias("no_tarjeta"), code.alias("cvv"), "emisor", "estado", "no_cuenta")


def _with_origin_account(transaccion: DataFrame, cuenta: DataFrame, *columns: str) -> DataFrame:
    """Left join on the origin account. Account numbers are unique, so no transaction is repeated; a hot
    account makes one side of a single join skewed, which adaptive execution splits."""
    origin = cuenta.select(F.col("no_cuenta").alias("cuenta_origen"), *columns)
    return transaccion.join(origin, "cuenta_origen", "left")


def fact_transacciones(transaccion: DataFrame, cuenta: DataFrame) -> DataFrame:
    return _with_origin_account(transaccion, cuenta, "id_cliente").select(
        "id_transaccion",
        "no_tarjeta",
        "cuenta_origen",
        "cuenta_destino",
        "monto",
        "tipo_movimiento",
        "fecha_transaccion",
        "id_cliente",
    )


def fact_prestamos(prestamo: DataFrame) -> DataFrame:
    return prestamo.select("id_prestamo", "estado", "monto", "id_cliente")


def pivot_model_credit(transaccion: DataFrame, cuenta: DataFrame) -> DataFrame:
    """Transactions with the type, balance and owner of their origin account.

    The client table adds neither a column nor, its key being unique, a row: it is not joined.
    """
    return _with_origin_account(transaccion, cuenta, "tipo_cuenta", "saldo", "id_cliente").select(
        "id_cliente",
        "id_transaccion",
        "cuenta_origen",
        "tipo_cuenta",
        "tipo_movimiento",
        "fecha_transaccion",
        "saldo",
        "monto",
    )


def silver_tables(bronze: Mapping[str, DataFrame], mask_cards: bool = False) -> dict[str, DataFrame]:
    return {
        "dim_clientes": dim_clientes(bronze["cliente"], bronze["cliente_tel"]),
        "dim_beneficiarios": dim_beneficiarios(bronze["beneficiario"], bronze["beneficiario_tel"]),
        "dim_cuentas": dim_cuentas(bronze["cuenta"]),
        "dim_tarjetas": dim_tarjetas(bronze["tarjeta"], mask_cards),
        "dim_fact_transacciones": fact_transacciones(bronze["transaccion"], bronze["cuenta"]),
        "dim_fact_prestamos": fact_prestamos(bronze["prestamo"]),
        "pivot_model_credit": pivot_model_credit(bronze["transaccion"], bronze["cuenta"]),
    }
