"""Set-based account rules: month-end fee, loan approval, client registration, an owner's own accounts."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudal.operators.ranking import with_row_number
from caudal.operators.skew import lookup_side
from caudal.schemas import FEE_ACCOUNT_TYPE, LOAN_APPROVED, LOAN_PENDING, MONEY
from caudal.session import materialise
from caudal.sources.files import with_defaults

FEE = "50.00"
FEE_CEILING = "1000.00"

LOAN_NOT_PENDING = "préstamo inexistente o no pendiente"
LOAN_NO_ACCOUNT = "cliente sin cuenta"

MISSING_VALUE = "dato obligatorio ausente"
CURP_TAKEN = "CURP repetida"
MAIL_TAKEN = "correo repetido"

# A CURP prefix has 900,000 numbers; so many draws in vain mean that they are all but used up.
MOST_DRAWS = 10_000


def month_end_fee(cuenta: DataFrame) -> DataFrame:
    """Charge the fee to fee-bearing accounts that can pay it and lie below the ceiling."""
    charged = (
        (F.col("tipo_cuenta") == FEE_ACCOUNT_TYPE)
        & (F.col("saldo") < F.lit(FEE_CEILING).cast(MONEY))
        & (F.col("saldo") >= F.lit(FEE).cast(MONEY))
    )
    after = F.when(charged, F.col("saldo") - F.lit(FEE).cast(MONEY)).otherwise(F.col("saldo"))
    return cuenta.withColumn("saldo", after.cast(MONEY))


def accounts_of(cuenta: DataFrame, cliente: DataFrame, principal: str | Column | None = None) -> DataFrame:
    """The accounts whose owner's CURP is the principal (the session user when none is given)."""
    who = F.current_user() if principal is None else principal if isinstance(principal, Column) else F.lit(principal)
    owner = cliente.select("id_cliente", "curp").where(F.col("curp") == who)
    return cuenta.join(owner, "id_cliente").select("no_cuenta", "tipo_cuenta", "saldo", "curp")


class LoanOutcome(NamedTuple):
    prestamo: DataFrame
    cuenta: DataFrame
    rejected: DataFrame


def authorize_loans(
    prestamo: DataFrame,
    cuenta: DataFrame,
    requested: DataFrame,
    pending: str = LOAN_PENDING,
    approved: str = LOAN_APPROVED,
) -> LoanOutcome:
    """Approve the requested ``id_prestamo`` that are pending and whose client has an account.

    The amount goes to the client's lowest account number. Approvals are added up per account before they
    meet the account table. What cannot be approved is returned with its reason.
    """
    first_account = cuenta.groupBy("id_cliente").agg(F.min("no_cuenta").alias("no_cuenta"))
    asked = requested.select("id_prestamo").distinct()
    decided = (
        asked.join(prestamo, "id_prestamo", "left")
        .join(lookup_side(first_account), "id_cliente", "left")
        .withColumn(
            "motivo",
            F.when(F.coalesce(F.col("estado") != pending, F.lit(True)), LOAN_NOT_PENDING).when(
                F.col("no_cuenta").isNull(), LOAN_NO_ACCOUNT
            ),
        )
    )
    granted = decided.where(F.col("motivo").isNull())
    loans = prestamo.join(
        granted.select("id_prestamo", F.lit(approved).alias("nuevo")), "id_prestamo", "left"
    ).withColumn("estado", F.coalesce("nuevo", "estado"))
    credits = granted.groupBy("no_cuenta").agg(F.sum("monto").alias("abono"))
    balances = cuenta.join(credits, "no_cuenta", "left").withColumn(
        "saldo", (F.col("saldo") + F.coalesce("abono", F.lit(0))).cast(MONEY)
    )
    return LoanOutcome(
        loans.select(*prestamo.columns),
        balances.select(*cuenta.columns),
        decided.where(F.col("motivo").isNotNull()).select("id_prestamo", "motivo"),
    )


class Registration(NamedTuple):
    cliente: DataFrame
    cuenta: DataFrame
    rejected: DataFrame


def account_number(curp: Column, attempt: int = 0) -> Column:
    """First four characters of the CURP and six digits drawn from its hash: a retry gives the same number.
    ``attempt`` draws another number for clients whose first one was taken."""
    seed = F.concat(curp, F.lit(str(attempt))) if attempt else curp
    drawn = F.conv(F.substring(F.md5(seed), 1, 8), 16, 10).cast("long") % 900000 + 100000
    return F.concat(F.substring(curp, 1, 4), drawn.cast("string"))


def _existing(batch: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """The batch's values of ``column`` that the table has already: the table is filtered, not shuffled whole."""
    return table.select(column).join(batch.select(column).distinct(), column, "left_semi").distinct()


def _without_conflict(pending: DataFrame) -> DataFrame:
    """The rows a row-by-row run would take: ``orden`` of those that no taken earlier row shares a value with.

    A pending row is taken once it is the first pending one with its CURP and with its e-mail, and then the
    others with either value go. A row that went holds nothing. The first row of all is always taken, so
    rounds end; each is a few joins by key over what is left.
    """
    taken = []
    while not pending.isEmpty():
        marked = pending
        for column in ("curp", "correo"):
            first = pending.groupBy(column).agg(F.min("orden").alias(f"_{column}"))
            marked = marked.join(lookup_side(first), column)
        now = materialise(marked.where("orden = _curp AND orden = _correo").select("orden", "curp", "correo"))
        taken.append(now.select("orden"))
        for column in ("curp", "correo"):
            pending = pending.join(now.select(column), column, "left_anti")
        pending = materialise(pending.select("orden", "curp", "correo"))
    return reduce(DataFrame.unionByName, taken) if taken else pending.select("orden")


def _with_numbers(rows: DataFrame, cuenta: DataFrame, attempt: int) -> DataFrame:
    """``rows`` with ``no_cuenta``. A drawn number that an account or an earlier row has is drawn again."""
    done = []
    while True:
        drawn = rows.withColumn("no_cuenta", account_number(F.col("curp"), attempt))
        first = drawn.groupBy("no_cuenta").agg(F.min("orden").alias("_first"))
        free = drawn.join(lookup_side(first), "no_cuenta").where("orden = _first").drop("_first")
        for used in (cuenta, *done):
            free = free.join(_existing(free, used, "no_cuenta"), "no_cuenta", "left_anti")
        done.append(materialise(free))
        rows = materialise(rows.join(done[-1].select("orden"), "orden", "left_anti"))
        if rows.isEmpty():
            return reduce(DataFrame.unionByName, done)
        attempt += 1
        if attempt > MOST_DRAWS:
            raise RuntimeError("no account number is left for some CURP prefix")


def register_clients(batch: DataFrame, cliente: DataFrame, cuenta: DataFrame, attempt: int = 0) -> Registration:
    """Register clients with their first account, as if row by row in order of arrival.

    ``batch`` has ``orden`` (unique, the order of arrival), ``nombre``, ``apellido_p``, ``apellido_m``,
    ``curp``, ``correo``, ``tipo_cuenta``, ``saldo_inicial``, and may carry other client columns. A row is
    refused when its CURP or e-mail exists, or an earlier row that was taken bears it; a refused row leaves
    nothing behind. Account numbers are drawn until they are free. New ids follow the highest existing one
    without gaps, in order of arrival.
    """
    needed = ("nombre", "apellido_p", "curp", "correo", "tipo_cuenta")
    absent = F.col(needed[0]).isNull()
    for column in needed[1:]:
        absent = absent | F.col(column).isNull()
    checked = batch.withColumn("_absent", absent)
    for column in ("curp", "correo"):
        there = _existing(batch, cliente, column).withColumn(f"_{column}", F.lit(True))
        checked = checked.join(lookup_side(there), column, "left")
    checked = materialise(checked)
    open_rows = checked.where("NOT _absent AND _curp IS NULL AND _correo IS NULL")
    taken = materialise(_without_conflict(open_rows.select("orden", "curp", "correo")).withColumn("_taken", F.lit(True)))
    checked = checked.join(taken, "orden", "left")
    for column in ("curp", "correo"):
        held = checked.where("_taken").select(column, F.col("orden").alias(f"_by_{column}"))
        checked = checked.join(lookup_side(held), column, "left")
        earlier = F.coalesce(F.col(f"_by_{column}") < F.col("orden"), F.lit(False))
        checked = checked.withColumn(f"_{column}", F.col(f"_{column}").isNotNull() | earlier).drop(f"_by_{column}")
    checked = checked.withColumn(
        "motivo",
        F.when(F.col("_absent"), MISSING_VALUE)
        .when(F.col("_curp"), CURP_TAKEN)
        .when(F.col("_correo"), MAIL_TAKEN),
    )
    numbered = _with_numbers(materialise(checked.where("_taken").drop("_absent", "_curp", "_correo", "_taken")), cuenta, attempt)
    highest = cliente.agg(F.coalesce(F.max("id_cliente"), F.lit(0)).alias("m")).scalar()
    accepted = with_row_number(numbered, ["orden"], "_n").withColumn("id_cliente", highest + F.col("_n"))
    surname = F.concat_ws(" ", "apellido_p", "apellido_m")
    return Registration(
        with_defaults(accepted.withColumn("apellido", surname), "cliente"),
        with_defaults(accepted.withColumn("saldo", F.col("saldo_inicial")), "cuenta"),
        checked.where(F.col("motivo").isNotNull()).select("orden", "curp", "motivo"),
    )
