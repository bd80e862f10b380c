"""Data-quality rules. Every rule yields ``(regla, fallas)``; zero failures passes.

Row rules of a table share one scan. Keys and references of all tables share another and one shuffle; they are counted by
value on the map side before it, so a value that fills a third of a table costs one row per task. What was counted adds
up: a report over what has arrived so far needs the tallies of the batches, not their rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudal.schemas import ACCOUNT_TYPES, BIOMETRIC_TYPES, REFERENCES, TABLES, Reference


@dataclass(frozen=True)
class RowRule:
    """``violated`` is an SQL predicate; as for a CHECK, NULL does not violate it."""

    table: str
    name: str
    violated: str


def _listed(values: Iterable[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


NEGATIVE_BALANCE = RowRule("cuenta", "cuenta.saldo negativo", "saldo < 0")
NONPOSITIVE_AMOUNT = RowRule("transaccion", "transaccion.monto no positivo", "monto <= 0")
ORPHAN_CLIENTS = "cliente sin cuenta"
BENEFICIARY_TOTAL = "cuenta con porcentajes distintos de 100"


def domain_rules(
    account_types: Sequence[str] = ACCOUNT_TYPES, biometric_types: Sequence[str] = BIOMETRIC_TYPES
) -> list[RowRule]:
    return [
        RowRule("cuenta", "cuenta.tipo_cuenta fuera de dominio", f"tipo_cuenta NOT IN ({_listed(account_types)})"),
        RowRule(
            "cliente_biometria",
            "cliente_biometria.tipo_biometria fuera de dominio",
            f"tipo_biometria NOT IN ({_listed(biometric_types)})",
        ),
        RowRule(
            "beneficiario",
            "beneficiario.porcentaje_saldo fuera de rango",
            "porcentaje_saldo <= 0 OR porcentaje_saldo > 100",
        ),
    ]


def not_null_rules() -> list[RowRule]:
    return [
        RowRule(t.name, f"{t.name}.{column} nulo", f"{column} IS NULL") for t in TABLES.values() for column in t.required
    ]


def length_rules() -> list[RowRule]:
    return [
        RowRule(t.name, f"{t.name}.{column} largo", f"length({column}) > {limit}")
        for t in TABLES.values()
        for column, limit in t.max_length.items()
    ]


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_rule_failures(tables: Mapping[str, DataFrame], rules: Sequence[RowRule]) -> DataFrame:
    """Count every rule; one aggregate per table."""
    by_table: dict[str, list[RowRule]] = {}
    for rule in rules:
        by_table.setdefault(rule.table, []).append(rule)
    counted = []
    for table, own in by_table.items():
        counts = tables[table].agg(*(F.count_if(F.expr(r.violated)).alias(f"r{i}") for i, r in enumerate(own)))
        pairs = [F.struct(F.lit(r.name).alias("regla"), F.col(f"r{i}").alias("fallas")) for i, r in enumerate(own)]
        counted.append(counts.select(F.inline(F.array(*pairs))))
    return _union(counted)


def offending_rows(tables: Mapping[str, DataFrame], rule: RowRule) -> DataFrame:
    """The rows that break a rule, for quarantine."""
    return tables[rule.table].where(F.expr(rule.violated))


def clients_without_account(cliente: DataFrame, cuenta: DataFrame) -> DataFrame:
    owners = cuenta.where(F.col("id_cliente").isNotNull()).select("id_cliente").distinct()
    return cliente.join(owners, "id_cliente", "left_anti")


def accounts_off_total(cuenta: DataFrame, beneficiario: DataFrame) -> DataFrame:
    """Accounts whose beneficiary percentages do not add up to 100; no beneficiary counts as 0."""
    totals = beneficiario.groupBy("no_cuenta").agg(F.sum("porcentaje_saldo").alias("total"))
    joined = cuenta.join(totals, "no_cuenta", "left").withColumn(
        "total", F.coalesce("total", F.lit(0).cast("decimal(5,2)"))
    )
    return joined.where(F.col("total") != 100)


def _tally(rows: DataFrame, rule: str) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("fallas")).select(F.lit(rule).alias("regla"), "fallas")


def negative_balance(tables: Mapping[str, DataFrame]) -> DataFrame:
    return row_rule_failures(tables, [NEGATIVE_BALANCE])


def nonpositive_amount(tables: Mapping[str, DataFrame]) -> DataFrame:
    return row_rule_failures(tables, [NONPOSITIVE_AMOUNT])


def orphan_clients(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _tally(clients_without_account(tables["cliente"], tables["cuenta"]), ORPHAN_CLIENTS)


def beneficiary_total(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _tally(accounts_off_total(tables["cuenta"], tables["beneficiario"]), BENEFICIARY_TOTAL)


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """Values of a unique column that occur more than once, with their row count."""
    return (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("filas")).where("filas > 1")
    )


@dataclass(frozen=True)
class Tally:
    """What the rules need to know of a set of rows. Tallies of two sets add up to that of both.

    ``rules`` is ``(regla, fallas)``, the row rules. ``keys`` has a row for each value of a unique column, or of a column
    that refers to one: ``dominio`` (the unique column), ``valor`` (as text; null only for rows whose own key is null),
    ``llaves`` (rows that have it as their own), ``hijos_0`` … (rows of each reference that point at it) and ``total`` (the
    percentages of its beneficiaries).
    """

    rules: DataFrame
    keys: DataFrame


TOTAL = "decimal(20,2)"


def _referring(parent: str) -> list[Reference]:
    """The references to a table; a reference's place here is that of its column in a tally."""
    return [r for r in REFERENCES if r.parent == parent]


CHILDREN = [f"hijos_{i}" for i in range(max(len(_referring(p)) for p in TABLES))]
_OWN_KEY = "llaves"
_SUMS = (_OWN_KEY, *CHILDREN, "total")


def _domain(table: str, column: str) -> str:
    return f"{table}.{column}"


def _entry(domain: str, column: str, counter: str, total: Column) -> Column:
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    counts = [(one if name == counter else none).alias(name) for name in (_OWN_KEY, *CHILDREN)]
    return F.struct(
        F.lit(domain).alias("dominio"), F.col(column).cast("string").alias("valor"), *counts, total.cast("decimal(5,2)").alias("total")
    )


def _key_entries(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Up to one entry a row for each of these unique columns and of its references, in one scan."""
    nothing = F.lit(0)
    entries = [_entry(_domain(table, c), c, _OWN_KEY, nothing) for c in columns]
    for ref in REFERENCES:
        if ref.child == table:
            share = F.coalesce("porcentaje_saldo", nothing) if table == "beneficiario" else nothing
            slot = CHILDREN[_referring(ref.parent).index(ref)]
            entries.append(_entry(_domain(ref.parent, TABLES[ref.parent].key), ref.column, slot, share))
    return df.select(F.inline(F.array(*entries))).where(F.col("valor").isNotNull() | (F.col(_OWN_KEY) > 0))


def _added_up(keys: DataFrame) -> DataFrame:
    sums = [F.sum(c).cast(TOTAL if c == "total" else "long").alias(c) for c in _SUMS]
    return keys.groupBy("dominio", "valor").agg(*sums)


def key_tally(tables: Mapping[str, DataFrame], only_referred: bool = False) -> DataFrame:
    """The ``keys`` of a tally: each table is read once and all of them meet in one shuffle, added up by value before it.

    ``only_referred`` leaves out unique columns that nothing refers to.
    """
    columns = {t.name: ([t.key] if _referring(t.name) else []) if only_referred else t.unique_columns for t in TABLES.values()}
    return _added_up(_union([_key_entries(tables[name], name, own) for name, own in columns.items()]))


def tally(tables: Mapping[str, DataFrame], rules: Sequence[RowRule] | None = None) -> Tally:
    """The tally of all rows: two scans a table, one for its row rules and one for its keys and references."""
    return Tally(row_rule_failures(tables, every_row_rule() if rules is None else rules), key_tally(tables))


def taken_off(t: Tally) -> Tally:
    """The tally that, added, takes the rows of ``t`` away again."""
    keys = t.keys.select("dominio", "valor", *((-F.col(c)).cast(TOTAL if c == "total" else "long").alias(c) for c in _SUMS))
    return Tally(t.rules.select("regla", (-F.col("fallas")).alias("fallas")), keys)


def added(tallies: Sequence[Tally]) -> Tally:
    """One tally for the rows of all of them."""
    rules = _union([t.rules for t in tallies]).groupBy("regla").agg(F.sum("fallas").alias("fallas"))
    return Tally(rules, _added_up(_union([t.keys for t in tallies])))


def _unique_rules() -> list[tuple[str, str, str]]:
    """``(dominio, medida, regla)``; so in the other lists."""
    return [
        (_domain(t.name, c), "repetidos", f"{t.name}.{c} repetido") for t in TABLES.values() for c in t.unique_columns
    ]


def _reference_rules() -> list[tuple[str, str, str]]:
    return [
        (_domain(r.parent, TABLES[r.parent].key), f"sin_padre_{_referring(r.parent).index(r)}", f"{r.child}.{r.column} sin {r.parent}")
        for r in REFERENCES
    ]


def _joined_rules() -> list[tuple[str, str, str]]:
    return [("cliente.id_cliente", "sin_cuenta", ORPHAN_CLIENTS), ("cuenta.no_cuenta", "no_suma", BENEFICIARY_TOTAL)]


def _key_failures(keys: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Count the named rules over added-up ``keys``; a rule without entries has no failure."""
    own = F.col(_OWN_KEY)
    accounts_of_client = CHILDREN[_referring("cliente").index(next(r for r in _referring("cliente") if r.child == "cuenta"))]

    def rows_where(met: Column, counted: Column) -> Column:
        return F.coalesce(F.sum(F.when(met, counted)), F.lit(0)).cast("long")

    measures = {
        "repetidos": F.count_if((own > 1) & F.col("valor").isNotNull()),
        "sin_cuenta": rows_where((own > 0) & (F.col(accounts_of_client) == 0), own),
        "no_suma": rows_where((own > 0) & (F.col("total") != 100), own),
        **{f"sin_padre_{i}": rows_where(own == 0, F.col(c)) for i, c in enumerate(CHILDREN)},
    }
    used = sorted({m for _, m, _ in rules})
    pairs = [F.struct(F.lit(m).alias("medida"), F.col(m).alias("fallas")) for m in used]
    # A row for each unique column and measure: some dozens, whatever the tables hold.
    measured = keys.groupBy("dominio").agg(*(measures[m].alias(m) for m in used)).select("dominio", F.inline(F.array(*pairs)))
    listed = [F.struct(*(F.lit(v).alias(n) for n, v in zip(("dominio", "medida", "regla"), rule, strict=True))) for rule in rules]
    named = keys.sparkSession.range(1, numPartitions=1).select(F.inline(F.array(*listed)))
    return named.join(F.broadcast(measured), ["dominio", "medida"], "left").select("regla", F.coalesce("fallas", F.lit(0).cast("long")).alias("fallas"))


def unique_failures(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Repeated values of every primary key and unique column."""
    return _union(
        [
            _tally(duplicate_values(tables[t.name], column), f"{t.name}.{column} repetido")
            for t in TABLES.values()
            for column in t.unique_columns
        ]
    )


def orphan_values(tables: Mapping[str, DataFrame], ref: Reference) -> DataFrame:
    """Values of a reference without a parent row, with the child rows that carry them."""
    parent_key = TABLES[ref.parent].key
    values = (
        tables[ref.child]
        .where(F.col(ref.column).isNotNull())
        .groupBy(F.col(ref.column).alias("valor"))
        .agg(F.count(F.lit(1)).alias("filas"))
    )
    return values.join(tables[ref.parent].select(F.col(parent_key).alias("valor")), "valor", "left_anti")


def reference_failures(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Child rows whose parent is missing, per reference."""
    return _key_failures(key_tally(tables, only_referred=True), _reference_rules())


def every_row_rule() -> list[RowRule]:
    return [NEGATIVE_BALANCE, NONPOSITIVE_AMOUNT, *domain_rules(), *not_null_rules(), *length_rules()]


def report_of(t: Tally) -> DataFrame:
    """Every rule as ``(regla, fallas, aprobada)``, from a tally."""
    every = t.rules.unionByName(_key_failures(t.keys, [*_joined_rules(), *_unique_rules(), *_reference_rules()]))
    return every.withColumn("aprobada", F.col("fallas") == 0)


def quality_report(tables: Mapping[str, DataFrame], rules: Sequence[RowRule] | None = None) -> DataFrame:
    """Every rule as ``(regla, fallas, aprobada)``; two scans a table."""
    return report_of(tally(tables, rules))


def core_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The four headline rules as ``(regla, fallas, aprobada)``."""
    every = _union(
        [
            row_rule_failures(tables, [NEGATIVE_BALANCE, NONPOSITIVE_AMOUNT]),
            orphan_clients(tables),
            beneficiary_total(tables),
        ]
    )
    return every.withColumn("aprobada", F.col("fallas") == 0)


def summary(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count(F.lit(1)).alias("reglas"),
        F.count_if(~F.col("aprobada")).alias("reglas_fallidas"),
        F.coalesce(F.sum("fallas"), F.lit(0).cast("long")).alias("fallas"),
    )
