"""Wide extracts: transactions with card, account, beneficiary, client and loan attributes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caudal.operators.ranking import with_counted_ntile, with_ntile
from caudal.operators.skew import lookup_side
from caudal.session import materialise, slice_count

WIDE_COLUMNS = (
    "id_cliente",
    "id_transaccion",
    "cuenta_origen",
    "tipo_cuenta",
    "tipo_movimiento",
    "fecha_transaccion",
    "saldo",
    "monto",
    "estado",
    "emisor",
)

FULL_COLUMNS = (
    "id_cliente",
    "id_transaccion",
    "cuenta_origen",
    "tipo_cuenta",
    "tipo_movimiento",
    "fecha_transaccion",
    "saldo",
    "monto_transaccion",
    "estado_tarjeta",
    "emisor",
    "estado_prestamo",
)

TILE = "bloque"
TILED_COLUMNS = (*FULL_COLUMNS, TILE)

# A transaction fixes every other column but these, so rows equal on them are equal throughout.
TILE_ORDER = ("id_cliente", "id_transaccion", "estado_tarjeta", "emisor", "estado_prestamo")


TIMES = "_times"
# A joined row stands for so many equal rows at most, and unfolds where it is.
BLOCK = 1000


def _counted(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Distinct rows of the columns with how often each occurs, added up on the map side."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def _times(*counts: str) -> Column:
    """How many rows joins with these counts would give; a missing match still gives one."""
    product = F.lit(1).cast("long")
    for name in counts:
        product = product * F.coalesce(F.col(name), F.lit(1).cast("long"))
    return product


def _unfolded(df: DataFrame) -> DataFrame:
    """Each row as often as its count says, where it is."""
    return df.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col(TIMES)))).drop("_row", TIMES)


def _meet(rows: DataFrame, held: DataFrame) -> DataFrame:
    """``rows`` ⟕ ``held`` by origin account, a result row standing for at most ``BLOCK`` equal ones.

    ``held``, small next to the rows, is written once, and the join planned and run once. Where no row of ``held`` counts
    for more than a block, a task's output follows the bytes that it reads, and adaptive execution splits hot accounts.
    """
    stored = materialise(held)
    if not stored.where(F.col(TIMES) > BLOCK).isEmpty():
        return _meet_heavy(rows, stored)
    return rows.join(lookup_side(stored), "cuenta_origen", "left").withColumn(TIMES, _times(TIMES))


def _meet_heavy(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """``_meet`` where few bytes can make many rows, which adaptive execution does not see.

    What each account will give is counted first, from its column of the rows alone. An account that gives more than a
    quarter of a task's even share, of which there are at most four a task, is laid out as a grid: its rows are split by id into
    parts, its blocks into salts, and every part meets every salt in a place of its own. Every other account is one place.
    """
    n = slice_count(rows.sparkSession)
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    blocks = F.floor((F.col(TIMES) + (BLOCK - 1)) / BLOCK)
    own = stored.groupBy("cuenta_origen").agg(F.sum(TIMES).alias("each"), F.sum(blocks).alias("blocks"))
    given = _counted(rows.where("cuenta_origen IS NOT NULL"), "cuenta_origen").join(lookup_side(own), "cuenta_origen", "left")
    given = materialise(given.withColumn("out", F.col("n").cast("double") * F.coalesce("each", one)))
    share = given.agg(F.sum("out")).first()[0] or 0.0
    cells = F.ceil(F.col("out") * 4 * n / F.lit(max(share, 1.0)))
    salts = F.least(cells, F.coalesce("blocks", one))
    grid = given.where(cells > 1).withColumns({"salts": salts, "parts": F.least(F.ceil(cells / salts), F.col("n"))})
    grid = F.broadcast(grid.select("cuenta_origen", "salts", "parts"))

    # Blocks of an account are numbered through, so that no salt is without one.
    earlier = Window.partitionBy("cuenta_origen").orderBy("_seq").rowsBetween(Window.unboundedPreceding, -1)
    spread = stored.join(grid, "cuenta_origen").withColumn("_seq", F.monotonically_increasing_id())
    spread = spread.withColumn("_before", F.coalesce(F.sum(blocks).over(earlier), zero)).drop("_seq")
    rest = stored.join(grid, "cuenta_origen", "left_anti").withColumns({"salts": one, "parts": one, "_before": zero})
    cut = spread.unionByName(rest).withColumn("_block", F.explode(F.sequence(zero, blocks - 1)))
    cut = cut.withColumn("_salt", F.pmod(F.col("_before") + F.col("_block"), F.col("salts")))
    cut = cut.withColumn(TIMES, F.least(F.col(TIMES) - F.col("_block") * BLOCK, F.lit(BLOCK).cast("long")))
    cut = cut.withColumn("_part", F.explode(F.sequence(zero, F.col("parts") - 1))).drop("salts", "parts", "_before", "_block")

    laid = rows.join(grid, "cuenta_origen", "left")
    laid = laid.withColumn("_part", F.pmod(F.xxhash64("id_transaccion"), F.coalesce("parts", one)))
    laid = laid.withColumn("_salt", F.explode(F.sequence(zero, F.coalesce("salts", one) - 1))).drop("salts", "parts")
    # One key of text, asked for by number: places are not put together again. Rows without an account are spread.
    place = F.concat_ws("/", "_part", "_salt", "cuenta_origen")
    alone = F.concat(F.lit("?"), F.col("id_transaccion").cast("string"))
    laid = laid.withColumn("_place", F.when(F.col("cuenta_origen").isNull(), alone).otherwise(place)).drop("_part", "_salt")
    cut = cut.withColumn("_place", place).drop("_part", "_salt", "cuenta_origen")
    met = laid.repartition(n, "_place").join(cut.hint("merge"), "_place", "left").drop("_place")
    return met.withColumn(TIMES, _times(TIMES))


def _attach(silver: Mapping[str, DataFrame], accounts: DataFrame, card_key: str) -> DataFrame:
    """Transactions ⟕ card ⟕ account, where ``accounts`` carries in ``_times`` how often each row counts.

    By ``no_cuenta`` a transaction meets every card of its origin account. Cards and accounts are put
    together first, both being small next to the transactions, which are shuffled at most once. Cards
    whose account row is missing are kept. By ``no_tarjeta`` it meets the one card it was made with.

    Equal matches travel as one row and a count, ``_times`` of the result: an account or a client with
    any number of cards, beneficiaries or loans is a handful of rows in every shuffle.
    """
    tx = silver["transacciones"].select(
        "id_transaccion", "tipo_movimiento", "monto", "fecha_transaccion", "cuenta_origen", "no_tarjeta"
    )
    tarjetas = silver["tarjetas"]
    accounts = accounts.withColumnRenamed("no_cuenta", "cuenta_origen")
    if card_key == "no_cuenta":
        cards = _counted(tarjetas, F.col("no_cuenta").alias("cuenta_origen"), "estado", "emisor")
        numbers = silver["cuentas"].select(F.col("no_cuenta").alias("cuenta_origen"))
        stray = cards.join(numbers, "cuenta_origen", "left_anti")
        held = accounts.join(cards, "cuenta_origen", "left").unionByName(stray, allowMissingColumns=True)
        held = held.withColumn(TIMES, _times(TIMES, "n")).drop("n")
        return _meet(tx, held)
    if card_key == "no_tarjeta":
        return _meet(tx.join(tarjetas.select("no_tarjeta", "estado", "emisor"), "no_tarjeta", "left"), accounts)
    raise ValueError(f"unknown card key {card_key!r}")


def wide_transactions(
    silver: Mapping[str, DataFrame], card_key: str = "no_cuenta", files: int | None = None
) -> DataFrame:
    """The ten-column extract. ``files`` spreads the rows evenly over that many output files.

    The client table would add no column and, its key being unique, no row: it is not joined.
    """
    accounts = silver["cuentas"].select(
        "no_cuenta", "tipo_cuenta", "saldo", "id_cliente", F.lit(1).cast("long").alias(TIMES)
    )
    wide = _attach(silver, accounts, card_key).select(*WIDE_COLUMNS, TIMES)
    # Card numbers are unique: by card nothing repeats.
    wide = wide.drop(TIMES) if card_key == "no_tarjeta" else _unfolded(wide)
    return wide.repartition(files) if files else wide


def _full_counted(silver: Mapping[str, DataFrame], card_key: str) -> DataFrame:
    """The eleven columns, equal rows as one with their number in ``_times``.

    Beneficiaries add no column but do multiply rows. A loan attaches only when its client row exists.
    """
    loans = _counted(silver["prestamos"], "id_cliente", F.col("estado").alias("estado_prestamo")).join(
        silver["clientes"].select("id_cliente"), "id_cliente", "left_semi"
    )
    beneficiaries = _counted(silver["beneficiarios"], "no_cuenta")
    accounts = (
        silver["cuentas"]
        .select("no_cuenta", "tipo_cuenta", "saldo", "id_cliente")
        .join(loans.withColumnRenamed("n", "loans"), "id_cliente", "left")
        .join(beneficiaries, "no_cuenta", "left")
        .withColumn(TIMES, _times("loans", "n"))
        .drop("loans", "n")
    )
    return (
        _attach(silver, accounts, card_key)
        .withColumnsRenamed({"monto": "monto_transaccion", "estado": "estado_tarjeta"})
        .select(*FULL_COLUMNS, TIMES)
    )


def full_transactions(silver: Mapping[str, DataFrame], card_key: str = "no_cuenta") -> DataFrame:
    """The eleven-column extract: one row per transaction × card × beneficiary × loan."""
    return _unfolded(_full_counted(silver, card_key))


def tiled_transactions(
    silver: Mapping[str, DataFrame],
    tiles: int = 4,
    card_key: str = "no_cuenta",
    method: str = "select",
) -> DataFrame:
    """The full extract with its tile number in ``bloque``, ordered by client.

    ``select`` and ``ranges`` tile the counted rows and unfold them last, where they are; ``window`` is the one-task window.
    """
    if method == "window":
        return with_ntile(full_transactions(silver, card_key), tiles, TILE_ORDER, TILE, method)
    tiled = with_counted_ntile(_full_counted(silver, card_key), tiles, TILE_ORDER, TILE, TIMES, method=method)
    return _unfolded(tiled).select(*TILED_COLUMNS)


def tile_frames(tiled: DataFrame, tiles: int = 4) -> dict[str, DataFrame]:
    """``{"bloque_1": frame, …}``: a view per tile. To write them, partition one write by ``bloque``."""
    return {f"{TILE}_{t}": tiled.where(F.col(TILE) == t) for t in range(1, tiles + 1)}
