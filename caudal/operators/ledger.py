"""Money movements: which transactions an account can pay for, and what they leave on the accounts.

Three ways to authorise a batch:

* ``opening``: compare each amount with the opening balance.
* ``running``: an account's debits are taken in id order; each sees the debits accepted before it.
  Credits arrive after the batch.
* ``serial``: transactions are taken one by one in id order, as if each were posted before the next is
  looked at. A debit also sees the credits its account has received from earlier accepted transactions.

``running`` and ``serial`` are exact. Accounts whose debits all fit the opening balance need no ordering
and are settled by one sum. The others become *legs*, settled in rounds:

* a round passes once over the undecided legs, by account and id, with a lower and an upper bound of the
  running balance;
* a debit not above the lower bound is accepted, one above the upper bound refused, and either way it is
  folded into the next undecided leg;
* what was decided is sent to the accounts it credits, and the next round starts.

The first undecided transaction of all always meets equal bounds, so each round decides something and
the loop ends by itself. An account is read whole, as a stream, by one task, unless it has more legs than
an even share of a task: then it is cut by id into several pieces, which start from bounds summed over
the earlier ones. Fewer accounts than tasks can be that large.

Accounts that keep paying each other with little money leave the bounds apart, and a round then decides
few. So ``serial`` looks at what ties the undecided legs together: accounts are linked by the undecided
transactions between them, and what happens in one connected group does not depend on any other. Groups are dealt to tasks
and each is taken one by one, exactly. A group larger than a task's even share, of which there are fewer than tasks,
is left to the rounds; after one, which may have cut it apart, links are looked for anew. What is still too large
is not handed over whole: its earliest legs are, as many as a task may have, and the rest gets its bounds and
its links anew. ``running`` has no such links, and nothing but rounds of bounds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import Window
from pyspark.sql import functions as F

from caudal.functions.money import cents, from_cents
from caudal.operators.components import GROUP, MEMBER, linked_groups
from caudal.operators.ranking import SLICE, range_slices
from caudal.operators.skew import lookup_side
from caudal.schemas import MONEY
from caudal.session import materialise, slice_count, store

UNKNOWN_ORIGIN = "cuenta de origen desconocida"
BAD_AMOUNT = "monto no positivo"
INSUFFICIENT = "saldo insuficiente"

DECISION_COLUMNS = ("id_transaccion", "cuenta_origen", "cuenta_destino", "monto", "aceptada", "motivo")

# An account with no more legs than this is never cut.
WHOLE_ACCOUNT_LEGS = 100_000

# A group of accounts with no more legs than this is always taken one by one in a task.
GROUP_LEGS = 100_000

# So few undecided legs are one group, linked or not: finding groups would take longer than the legs.
ONE_GROUP_LEGS = 20_000

# Undecided credits kept back, per account, in case no undecided debit follows.
HELD_LEGS = 10_000

DEBIT, CREDIT, CARRY = 0, 1, 2
REACH = "hasta"

LEG_COLUMNS = {
    "cuenta": "string",
    SLICE: "int",
    "id": "long",
    "kind": "int",
    "amount": "long",
    "other": "string",
    "pre": "long",
    "opening": "long",
    "split": "boolean",
    "accepted": "boolean",
}
LEG_SCHEMA = ", ".join(f"{name} {dtype}" for name, dtype in LEG_COLUMNS.items())


def movements(transactions: DataFrame) -> DataFrame:
    """What decisions are made from."""
    return transactions.select("id_transaccion", "cuenta_origen", "cuenta_destino", "monto")


def _decided(df: DataFrame, reason) -> DataFrame:
    with_reason = df.withColumn("motivo", reason)
    return with_reason.withColumn("aceptada", F.col("motivo").isNull()).select(*DECISION_COLUMNS)


def _bad_amount():
    return F.coalesce(F.col("monto") <= 0, F.lit(True))


def authorize_opening(transactions: DataFrame, cuenta: DataFrame) -> DataFrame:
    """Each transaction against its origin's opening balance; a balance equal to the amount will do."""
    opening = cuenta.select(F.col("no_cuenta").alias("cuenta_origen"), "saldo")
    reason = (
        F.when(_bad_amount(), BAD_AMOUNT)
        .when(F.col("saldo").isNull(), UNKNOWN_ORIGIN)
        .when(F.col("saldo") < F.col("monto"), INSUFFICIENT)
    )
    return _decided(movements(transactions).join(opening, "cuenta_origen", "left"), reason)


def authorize(transactions: DataFrame, cuenta: DataFrame, mode: str = "serial") -> DataFrame:
    """Decide every transaction: ``DECISION_COLUMNS``, ``motivo`` being NULL when accepted."""
    if mode == "opening":
        return authorize_opening(transactions, cuenta)
    if mode not in ("running", "serial"):
        raise ValueError(f"unknown mode {mode!r}")
    tx = movements(transactions)
    debits = (
        tx.where(~_bad_amount()).groupBy(F.col("cuenta_origen").alias("no_cuenta")).agg(F.sum("monto").alias("debits"))
    )
    # Only the origins of good amounts can matter to what is decided.
    state = cuenta.select("no_cuenta", "saldo").join(debits, "no_cuenta")
    short = F.coalesce(F.col("debits") > F.col("saldo"), F.lit(False))
    origin = state.select(
        F.col("no_cuenta").alias("cuenta_origen"), cents(F.col("saldo")).alias("opening"), short.alias("short")
    )
    opened = materialise(tx.join(lookup_side(origin), "cuenta_origen", "left"))
    reason = F.when(_bad_amount(), BAD_AMOUNT).when(F.col("opening").isNull(), UNKNOWN_ORIGIN)
    waits = F.coalesce(F.col("short"), F.lit(False)) & ~_bad_amount()

    legs = opened.where(waits).select(
        F.col("cuenta_origen").alias("cuenta"),
        F.col("id_transaccion").alias("id"),
        F.lit(DEBIT).alias("kind"),
        cents(F.col("monto")).alias("amount"),
        F.col("cuenta_destino").alias("other"),
        "opening",
        F.lit(None).cast("boolean").alias("accepted"),
    )
    if mode == "serial":
        # Only short accounts need their credits; each has a debit, so it is found among the origins.
        receivers = (
            opened.where("short").groupBy(F.col("cuenta_origen").alias("cuenta_destino")).agg(F.max("opening").alias("opening"))
        )
        paid_in = opened.where(~_bad_amount() & F.col("opening").isNotNull()).drop("opening")
        legs = legs.unionByName(
            paid_in.join(lookup_side(receivers), "cuenta_destino").select(
                F.col("cuenta_destino").alias("cuenta"),
                F.col("id_transaccion").alias("id"),
                F.lit(CREDIT).alias("kind"),
                cents(F.col("monto")).alias("amount"),
                F.lit(None).cast("string").alias("other"),
                "opening",
                F.when(~F.col("short"), F.lit(True)).alias("accepted"),
            )
        )
    settled = settle(legs, group_legs=GROUP_LEGS if mode == "serial" else 0).select(
        F.col("id").alias("id_transaccion"),
        F.col("cuenta").alias("cuenta_origen"),
        F.col("other").alias("cuenta_destino"),
        from_cents(F.col("amount")).alias("monto"),
        F.col("accepted").alias("aceptada"),
        F.when(~F.col("accepted"), INSUFFICIENT).alias("motivo"),
    )
    return _decided(opened.where(~waits), reason).unionByName(settled)


def accepted(decisions: DataFrame) -> DataFrame:
    return decisions.where("aceptada")


def rejected(decisions: DataFrame) -> DataFrame:
    return decisions.where("NOT aceptada")


def net_change(movements: DataFrame) -> DataFrame:
    """What accepted movements change on each account, added up on the map side before the shuffle."""
    out = movements.select(F.col("cuenta_origen").alias("no_cuenta"), (-F.col("monto")).alias("cambio"))
    into = movements.select(F.col("cuenta_destino").alias("no_cuenta"), F.col("monto").alias("cambio"))
    return out.unionByName(into).groupBy("no_cuenta").agg(F.sum("cambio").alias("cambio"))


def apply_change(cuenta: DataFrame, change: DataFrame) -> DataFrame:
    after = (F.col("saldo") + F.coalesce("cambio", F.lit(0))).cast(MONEY)
    return cuenta.join(change, "no_cuenta", "left").withColumn("saldo", after).select(*cuenta.columns)


def post_balances(cuenta: DataFrame, movements: DataFrame) -> DataFrame:
    """Balances after the movements: the origin pays, the destination receives when it exists. Every
    movement type moves money, and a transfer to oneself changes nothing."""
    return apply_change(cuenta, net_change(movements))


def settle(
    legs: DataFrame,
    slices: int | None = None,
    whole_account_legs: int = WHOLE_ACCOUNT_LEGS,
    group_legs: int = GROUP_LEGS,
) -> DataFrame:
    """Decide every debit leg. Returns the debit legs with ``accepted`` set.

    With ``group_legs`` 0 nothing is taken one by one.
    """
    spark = legs.sparkSession
    n = slices or slice_count(spark)
    is_debit = F.col("kind") == DEBIT
    decided = is_debit & F.col("accepted").isNotNull()
    measures = (
        F.count_if(decided).alias("decided"),
        F.count_if(~decided).alias("legs"),
        F.count_if(is_debit & F.col("accepted").isNull()).alias("undecided"),
    )
    watch = Observation()
    legs = materialise(legs.observe(watch, *measures))
    seen = watch.get
    open_legs, cut = _place(legs, seen["legs"], n, whole_account_legs)
    nothing = open_legs.where(decided)
    rounds: list[str] = []

    def stored(legs_now: DataFrame) -> DataFrame:
        rounds.append(store(legs_now))
        return spark.read.schema(LEG_SCHEMA).parquet(rounds[-1])

    if seen["undecided"] and group_legs and not _ids_repeat(open_legs):
        grouped, reach = _grouped(open_legs, seen["legs"], n, group_legs, stretches=False)
        stored(_fold(grouped, n))
        if not reach:
            seen["undecided"] = 0
        else:
            open_legs = materialise(grouped.where(F.col(REACH).isNotNull()).select(*LEG_COLUMNS))
            seen = open_legs.agg(*measures).first().asDict()
    while seen["undecided"]:
        watch = Observation()
        scanned = stored(
            _with_bounds(open_legs, cut)
            .repartitionById(n, F.col(SLICE))
            .sortWithinPartitions(SLICE, "cuenta", "id", "kind")
            .mapInPandas(_scanner(), LEG_SCHEMA)
            .observe(watch, *measures)
        )
        seen = watch.get
        if not seen["decided"]:
            raise RuntimeError("no transaction could be decided: is id_transaccion unique?")
        # Debits decided now are known credits from here on.
        news = scanned.where(decided).select("id", F.lit(CREDIT).alias("kind"), F.col("accepted").alias("news"))
        open_legs = (
            scanned.where(~decided)
            .join(news, ["id", "kind"], "left")
            .withColumn("accepted", F.coalesce("accepted", "news"))
            .select(*LEG_COLUMNS)
        )
        if seen["undecided"] and group_legs:
            grouped, reach = _grouped(open_legs, seen["legs"], n, group_legs)
            taken = stored(_fold(grouped, n))
            if not reach:
                break
            later = F.col("id") > F.col(REACH)
            open_legs = grouped.where(later).select(*LEG_COLUMNS).unionByName(taken.where(~decided))
            open_legs = materialise(open_legs)
            seen = open_legs.agg(*measures).first().asDict()
    return spark.read.schema(LEG_SCHEMA).parquet(*rounds).where(decided) if rounds else nothing


def _ids_repeat(legs: DataFrame) -> bool:
    """Whether an id is null or has several debits, so that a credit can't tell which of them pays it."""
    debits = legs.where(F.col("kind") == DEBIT).groupBy("id").agg(F.count(F.lit(1)).alias("debits"))
    return not debits.where("id IS NULL OR debits > 1").isEmpty()


def _grouped(legs: DataFrame, total: int, slices: int, group_legs: int, stretches: bool = True) -> tuple[DataFrame, bool]:
    """The legs with their group of linked accounts and how far, by id, the group is taken now: null for the whole of
    it. Also tells whether any group is too large to be.

    A group is when it has more legs than ``group_legs`` and than the even share of a task: fewer than ``slices`` are.
    Nothing of it is taken now without ``stretches``.
    """
    whole = F.lit(None).cast("long").alias(REACH)
    if total <= min(group_legs, ONE_GROUP_LEGS):
        return legs.select("*", F.lit("").alias(GROUP), whole), False
    open_ids = legs.where(F.col("accepted").isNull() & F.col("kind").isin(DEBIT, CREDIT))
    links = open_ids.groupBy("id").agg(F.min("cuenta").alias("a"), F.max("cuenta").alias("b")).where("a < b")
    groups = lookup_side(materialise(linked_groups(links, "a", "b").withColumnRenamed(MEMBER, "cuenta")))
    own = F.coalesce(GROUP, "cuenta")
    of_account = legs.groupBy("cuenta").agg(F.count(F.lit(1)).alias("legs"), F.min("id").alias("first"), F.max("id").alias("last"))
    sizes = (
        of_account.join(groups, "cuenta", "left")
        .groupBy(own.alias(GROUP))
        .agg(F.sum("legs").alias("legs"), F.min("first").alias("first"), F.max("last").alias("last"))
    )
    grouped = legs.join(groups, "cuenta", "left").withColumn(GROUP, own)
    most = max(group_legs, total // slices)
    large = {r[GROUP]: [r.first, r.last, r.legs] for r in sizes.where(F.col("legs") > most).collect()}
    if not large:
        return grouped.select("*", whole), False
    grouped = materialise(grouped)
    reach = _reaches(grouped, large, most) if stretches else {g: first - 1 for g, (first, *_) in large.items()}
    table = legs.sparkSession.createDataFrame(list(reach.items()), f"{GROUP} string, {REACH} long")
    return grouped.join(F.broadcast(table), GROUP, "left"), True  # fewer rows than tasks


def _reaches(grouped: DataFrame, large: dict[str, list[int]], most: int) -> dict[str, int]:
    """For each large group an id up to which it has at most twice ``most`` legs: guessed from an even spread, and halved until true."""
    reach = {g: first + (last - first) * most // legs for g, (first, last, legs) in large.items()}
    unsure = set(reach)
    while unsure:
        table = grouped.sparkSession.createDataFrame([(g, reach[g]) for g in unsure], f"{GROUP} string, {REACH} long")
        early = grouped.join(F.broadcast(table), GROUP).where(F.col("id") <= F.col(REACH))
        counts = {r[GROUP]: r[1] for r in early.groupBy(GROUP).agg(F.count(F.lit(1))).collect()}
        unsure = {g for g in unsure if counts.get(g, 0) > 2 * most and reach[g] > large[g][0]}
        for g in unsure:
            reach[g] = (large[g][0] + reach[g]) // 2
    return reach


def _fold(grouped: DataFrame, slices: int) -> DataFrame:
    """Every group's legs up to its reach one by one, groups side by side."""
    now = grouped.where(F.col(REACH).isNull() | (F.col("id") <= F.col(REACH)))
    dealt = now.repartition(slices, GROUP).sortWithinPartitions(GROUP, "id", "kind")
    return dealt.mapInArrow(_one_by_one(), LEG_SCHEMA)


def _as_legs(df: DataFrame, split: bool) -> DataFrame:
    return (
        df.withColumn("split", F.lit(split)).withColumn("pre", F.lit(0).cast("long")).select(*LEG_COLUMNS)
    )


def _place(legs: DataFrame, total: int, slices: int, whole_account_legs: int) -> tuple[DataFrame, bool]:
    """Give each leg its piece, and tell whether any account is cut.

    Whole accounts are spread by hash. An account is cut when it has more legs than ``whole_account_legs``
    and than the even share of a piece; fewer than ``slices`` accounts can be that large.
    """
    if total <= whole_account_legs:
        return _as_legs(legs.withColumn(SLICE, F.pmod(F.hash("cuenta"), F.lit(slices))), False), False
    sizes = legs.groupBy("cuenta").agg(F.count(F.lit(1)).alias("legs"))
    large = sizes.where((F.col("legs") > whole_account_legs) & (F.col("legs") * slices > total)).select("cuenta")
    large = materialise(large)
    cut = not large.isEmpty()
    if cut:
        whole = legs.join(F.broadcast(large), "cuenta", "left_anti")
        pieces = range_slices(legs.join(F.broadcast(large), "cuenta", "left_semi"), ["cuenta", "id", "kind"], slices)
    else:
        whole, pieces = legs, None
    placed = _as_legs(whole.withColumn(SLICE, F.pmod(F.hash("cuenta"), F.lit(slices))), False)
    return (placed.unionByName(_as_legs(pieces, True)) if cut else placed), cut


def _with_bounds(legs: DataFrame, cut: bool) -> DataFrame:
    """Add ``lo`` and ``hi``, the balance bounds at the start of the leg's piece: the opening balance, but
    for pieces of an account that is cut."""
    if not cut:
        return legs.withColumn("lo", F.col("opening")).withColumn("hi", F.col("opening"))
    return (
        legs.join(F.broadcast(_slice_bounds(legs)), ["cuenta", SLICE], "left")
        .withColumn("lo", F.when(F.col("split"), F.col("lo")).otherwise(F.col("opening")))
        .withColumn("hi", F.when(F.col("split"), F.col("hi")).otherwise(F.col("opening")))
    )


def _slice_bounds(legs: DataFrame) -> DataFrame:
    """Balance bounds at the start of each piece of an account that is cut. Accounts and pieces are both
    fewer than the tasks, and a piece holds a run of accounts: at most twice that many rows.

    Whatever happens, a balance never falls below its opening or zero, whichever is lower.
    """
    settled_credit = F.when((F.col("kind") == CREDIT) & F.col("accepted"), F.col("amount")).otherwise(0)
    open_credit = F.when((F.col("kind") == CREDIT) & F.col("accepted").isNull(), F.col("amount")).otherwise(0)
    open_debit = F.when(F.col("kind") == DEBIT, F.col("amount")).otherwise(0)
    sums = (
        legs.where("split")
        .groupBy("cuenta", SLICE)
        .agg(
            F.max("opening").alias("opening"),
            F.sum(F.col("pre") + settled_credit - open_debit).alias("down"),
            F.sum(F.col("pre") + settled_credit + open_credit).alias("up"),
        )
    )
    earlier = Window.partitionBy("cuenta").orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    floor = F.least(F.col("opening"), F.lit(0).cast("long"))
    return sums.select(
        "cuenta",
        SLICE,
        F.greatest(F.col("opening") + F.coalesce(F.sum("down").over(earlier), F.lit(0)), floor).alias("lo"),
        (F.col("opening") + F.coalesce(F.sum("up").over(earlier), F.lit(0))).alias("hi"),
    )


def _scanner() -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """One ordered pass over pieces: decide debits from the bounds, fold in what is decided.

    Emits decided debits, undecided legs, and for a cut account what is left over at the piece's end.
    Credits after an account's last undecided debit cannot matter, and are held back until one follows.
    The pass is a local function so that it travels to the executors by value: they need no package.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = list(LEG_COLUMNS)
        group = None
        low = high = pending = last_id = 0
        held: list[tuple] = []
        last_debit = last_verdict = None

        def close() -> list[tuple]:
            if group is None or not group[2] or not pending:
                return []
            return [(group[1], group[0], last_id, CARRY, 0, None, pending, group[3], True, None)]

        for batch in batches:
            out: list[tuple] = []
            fields = (batch[c].tolist() for c in (*columns, "lo", "hi"))
            for cuenta, piece, key, kind, amount, other, pre, opening, split, known, lo, hi in zip(*fields):
                if group is None or group[0] != piece or group[1] != cuenta:
                    out += close()
                    group = (piece, cuenta, split, opening)
                    low, high, pending, held = lo, hi, 0, []
                    last_debit = last_verdict = None
                last_id = key
                low += pre
                high += pre
                pending += pre
                if kind == DEBIT:
                    if low >= amount:
                        verdict = True
                        low, high, pending = low - amount, high - amount, pending - amount
                    elif high < amount:
                        verdict = False
                    else:
                        verdict = None
                        out += held
                        held = []
                        low, high = min(low, 0), max(high - amount, amount - 1)
                    last_debit, last_verdict = key, verdict
                    carried = pending if verdict is None else 0
                    out.append((cuenta, piece, key, kind, amount, other, carried, opening, split, verdict))
                    if verdict is None:
                        pending = 0
                elif kind == CREDIT:
                    if known is None and key == last_debit:
                        known = last_verdict
                    if known is None:
                        high += amount
                        leg = (cuenta, piece, key, kind, amount, other, pending, opening, split, None)
                        pending = 0
                        held.append(leg)
                        if split or len(held) >= HELD_LEGS:
                            out += held
                            held = []
                    elif known:
                        low, high, pending = low + amount, high + amount, pending + amount
            yield pd.DataFrame(out, columns=columns)
        yield pd.DataFrame(close(), columns=columns)

    return scan


def _one_by_one() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Groups in turn, each one's legs in id order and decided from the exact balance. Emits decided debits and, of a
    group that is not taken whole, what its accounts' later legs start from. A local function for the same reason as above."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = list(LEG_COLUMNS)
        schema = group = reach = None
        balance: dict[str, int] = {}
        last_leg: dict[str, tuple] = {}
        verdicts: dict[int, bool] = {}

        def rest() -> list[tuple]:
            if reach is None:
                return []
            return [
                (cuenta, piece, reach, CARRY, 0, None, balance[cuenta] - opening, opening, split, None)
                for cuenta, (piece, opening, split) in last_leg.items()
            ]

        def as_batch(legs: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*legs), schema)], schema=schema)

        for batch in batches:
            schema = schema or pa.schema([batch.schema.field(c) for c in columns])
            values = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in (*columns, GROUP, REACH) if c != "other"}
            until = [None if x is None else int(x) for x in batch.column(REACH).to_pylist()] if batch.column(REACH).null_count < len(batch) else None
            fields = (values[c].tolist() for c in ("cuenta", "id", "kind", "amount", "pre", "opening", "accepted", GROUP))
            carried: list[tuple] = []
            decided: list[bool] = []
            for at, (cuenta, key, kind, amount, pre, opening, known, own) in enumerate(zip(*fields)):
                if own != group:
                    carried += rest()
                    group, reach = own, until and until[at]
                    balance, last_leg, verdicts = {}, {}, {}
                money = balance.get(cuenta, opening) + pre
                if kind == DEBIT:
                    verdict = verdicts[key] = money >= amount
                    if verdict:
                        money -= amount
                    decided.append(verdict)
                elif kind == CREDIT and (verdicts[key] if known is None else known):
                    money += amount
                balance[cuenta] = money
                if reach is not None:
                    last_leg[cuenta] = (int(values[SLICE][at]), opening, bool(values["split"][at]))
            debits = batch.filter(pa.array(values["kind"] == DEBIT))
            new = {"pre": pa.array([0] * len(decided), pa.int64()), "accepted": pa.array(decided, pa.bool_())}
            yield pa.RecordBatch.from_arrays([new.get(c, debits.column(c)) for c in columns], schema=schema)
            if carried:
                yield as_batch(carried)
        if carried := rest():
            yield as_batch(carried)

    return take
