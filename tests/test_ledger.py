import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from caudal.operators import components, ledger
from caudal.operators.components import linked_groups
from caudal.operators.ledger import BAD_AMOUNT, INSUFFICIENT, UNKNOWN_ORIGIN, accepted, authorize, post_balances, rejected
from conftest import rows

TX = "id_transaccion long; cuenta_origen string; cuenta_destino string; monto decimal(16,2)"
ACCOUNTS = "no_cuenta string; tipo_cuenta string; saldo decimal(12,2); id_cliente long"


def one_by_one(tx, accounts, mode):
    """Plain loop over the transactions in id order: accepted ids and final balances."""
    balance = dict(accounts)
    taken, later = set(), []
    for key, origin, target, amount in sorted(tx):
        if amount is None or amount <= 0 or origin not in balance or balance[origin] < amount:
            continue
        taken.add(key)
        balance[origin] -= amount
        if target in balance:
            if mode == "serial":
                balance[target] += amount
            else:
                later.append((target, amount))
    for target, amount in later:
        balance[target] += amount
    return taken, balance


def random_case(seed, count, accounts, hot):
    rng = random.Random(seed)
    names = [f"a{i:02d}" for i in range(accounts)]

    def pick(extra=()):
        return names[rng.randrange(2)] if rng.random() < hot else rng.choice([*names, *extra])

    tx = [(i, pick(["??"]), pick(["zz"]), Decimal(rng.randint(1, 30000)) / 100) for i in range(count)]
    return tx, [(n, Decimal(rng.randint(-5000, 200000)) / 100) for n in names]


def frames(frame, tx, accounts):
    return (
        frame([(k, o, d, None if m is None else str(m)) for k, o, d, m in tx], TX),
        frame([(n, "Ahorro", str(b), 1) for n, b in accounts], ACCOUNTS),
    )


@pytest.mark.parametrize("mode", ["running", "serial"])
@pytest.mark.parametrize(
    "settings",
    [
        {},  # one group
        {"group_legs": 41},  # groups whole, but for the large one
        {"group_legs": 40},  # a large group in stretches
        {"group_legs": 40, "whole_account_legs": 5},  # and large accounts cut
        {"group_legs": 0, "whole_account_legs": 5},  # bounds alone
    ],
    ids=["one", "groups", "stretches", "cut", "bounds"],
)
def test_exact_against_a_loop(frame, monkeypatch, mode, settings):
    # Hot accounts make rounds depend on each other; the last setting gets a case with few such rounds.
    count, hot = (60, 0.3) if settings.get("group_legs") == 0 else (250, 0.4)
    tx, accounts = random_case(7, count, 12, hot)
    settle = ledger.settle
    monkeypatch.setattr(ledger, "settle", lambda legs, **own: settle(legs, **{**own, **settings, "slices": 4 if settings.get("group_legs") == 41 else 16}))
    txs, cuenta = frames(frame, tx, accounts)
    decisions = authorize(txs, cuenta, mode)
    taken, balance = one_by_one(tx, accounts, mode)
    assert {r[0] for r in accepted(decisions).select("id_transaccion").collect()} == taken
    assert decisions.count() == count and decisions.columns == list(ledger.DECISION_COLUMNS)
    after = {r["no_cuenta"]: r["saldo"] for r in post_balances(cuenta, accepted(decisions)).collect()}
    assert after == balance
    if mode == "serial":
        start = dict(accounts)
        assert all(after[n] >= min(start[n], 0) for n in after)


def test_many_rings_are_settled_side_by_side(spark, frame, monkeypatch):
    """Rings of four accounts that pass little money on: over 100,000 legs that bounds leave undecided, in groups for all tasks."""
    rings, size, laps = 1500, 4, 11
    rng = random.Random(3)
    accounts = {f"r{r}a{i}": 100 if i == 0 else 0 for r in range(rings) for i in range(size)}
    tx = []
    for lap in range(laps):
        for r in range(rings):
            for i in range(size):
                tx.append((len(tx), f"r{r}a{i}", f"r{r}a{(i + 1) % size}", rng.randint(1, 120)))
    spread = {}
    fold = ledger._fold

    def watched(grouped, slices):
        out = fold(grouped, slices)
        spread["legs"] = grouped.count()
        spread["tasks"] = {r[0]: r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()}
        return out

    monkeypatch.setattr(ledger, "_fold", watched)
    monkeypatch.setattr(ledger, "slice_count", lambda _: 16)
    txs = spark.createDataFrame(tx, "id_transaccion long, cuenta_origen string, cuenta_destino string, m long").selectExpr("*", "CAST(m AS decimal(16,2)) AS monto")
    cuenta = spark.createDataFrame(list(accounts.items()), "no_cuenta string, s long").selectExpr("no_cuenta", "CAST(s AS decimal(12,2)) AS saldo")
    decisions = accepted(authorize(txs, cuenta, "serial"))
    taken, _ = one_by_one([(k, o, d, Decimal(m)) for k, o, d, m in tx], {n: Decimal(s) for n, s in accounts.items()}.items(), "serial")
    assert {r[0] for r in decisions.select("id_transaccion").collect()} == taken
    assert spread["legs"] > 100_000 and len(spread["tasks"]) == 16
    assert max(spread["tasks"].values()) < 2 * sum(spread["tasks"].values()) / 16


def test_groups_are_connected_components(spark):
    rng = random.Random(9)
    links = [(f"n{rng.randrange(400)}", f"n{rng.randrange(400)}") for _ in range(260)]
    links += [(f"chain{i:03d}", f"chain{i + 1:03d}") for i in range(150)] + [("hub", f"spoke{i}") for i in range(200)]
    links += [("alone", "alone"), (None, "alone"), ("n0", None)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            parent[root(a)] = root(b)
    got = {r.miembro: r.grupo for r in linked_groups(spark.createDataFrame(links, "a string, b string"), "a", "b").collect()}
    assert set(got) == set(parent)
    assert len({(root(x), got[x]) for x in got}) == len({root(x) for x in got}) == len(set(got.values()))
    assert all(root(g) == root(x) for x, g in got.items())
    assert linked_groups(spark.createDataFrame([], "a string, b string"), "a", "b").collect() == []


def test_serial_sees_credits_and_running_does_not(frame):
    tx = [(1, "a", "b", Decimal(10)), (2, "b", "c", Decimal(10)), (3, "c", "a", Decimal(10))]
    txs, cuenta = frames(frame, tx, [("a", 10), ("b", 0), ("c", 0)])
    assert accepted(authorize(txs, cuenta, "serial")).count() == 3
    assert accepted(authorize(txs, cuenta, "running")).count() == 1
    assert accepted(authorize(txs, cuenta, "opening")).count() == 1


def test_reasons_and_boundaries(frame):
    tx = [
        (1, "a", "b", Decimal("10.00")),  # exactly the balance
        (2, "a", "b", Decimal("0.01")),
        (3, "nadie", "b", Decimal(1)),
        (4, "a", "b", Decimal(0)),
        (5, "a", "b", Decimal(-5)),
        (6, "a", "b", None),
        (7, None, "b", Decimal(1)),
        (8, "nulo", "b", Decimal(1)),
        (9, "b", "b", Decimal(7)),  # to itself
    ]
    txs, cuenta = frames(frame, tx, [("a", "10.00"), ("b", "7.00")])
    cuenta = cuenta.unionByName(frame([("nulo", "Ahorro", None, 1)], ACCOUNTS))
    for mode in ("opening", "running", "serial"):
        got = {r["id_transaccion"]: r["motivo"] for r in authorize(txs, cuenta, mode).collect()}
        short = None if mode == "opening" else INSUFFICIENT
        assert got == {
            1: None,
            2: short,
            3: UNKNOWN_ORIGIN,
            4: BAD_AMOUNT,
            5: BAD_AMOUNT,
            6: BAD_AMOUNT,
            7: UNKNOWN_ORIGIN,
            8: UNKNOWN_ORIGIN,
            9: None,
        }


def test_self_transfers_leave_money_to_spend(frame):
    tx = [(i, "a", "a", Decimal(5)) for i in range(6)]
    txs, cuenta = frames(frame, tx, [("a", 5)])
    assert accepted(authorize(txs, cuenta, "serial")).count() == 6
    assert accepted(authorize(txs, cuenta, "running")).count() == 1
    assert post_balances(cuenta, txs).first()["saldo"] == 5


def test_decisions_are_the_whole_batch(sample):
    tx = sample["transaccion_escalada"]
    for mode in ("opening", "running", "serial"):
        d = authorize(tx, sample["cuenta"], mode)
        both = accepted(d).unionByName(rejected(d)).select("id_transaccion")
        assert both.exceptAll(tx.select("id_transaccion")).count() == 0
        assert both.count() == tx.count()


def test_posting_conserves_money_between_known_accounts(sample):
    cuenta = sample["cuenta"]
    known = cuenta.select("no_cuenta")
    inside = (
        sample["transaccion_escalada"]
        .join(known.withColumnRenamed("no_cuenta", "cuenta_origen"), "cuenta_origen", "left_semi")
        .join(known.withColumnRenamed("no_cuenta", "cuenta_destino"), "cuenta_destino", "left_semi")
    )
    total = F.sum("saldo")
    assert rows(post_balances(cuenta, inside).agg(total)) == rows(cuenta.agg(total))


def test_unknown_mode_and_repeated_ids(frame, sample):
    with pytest.raises(ValueError):
        authorize(sample["transaccion_escalada"], sample["cuenta"], "hopeful")


def test_groups_that_fit_a_task_need_no_round(frame, monkeypatch):
    def scanner():
        raise AssertionError("a round of bounds")

    monkeypatch.setattr(ledger, "_scanner", scanner)
    monkeypatch.setattr(ledger, "ONE_GROUP_LEGS", 0)
    tx, accounts = [], []
    for part in "pq":
        own, balances = random_case(11, 150, 8, 0.4)
        tx += [(2 * k + (part == "q"), part + o, part + d, m) for k, o, d, m in own]
        accounts += [(part + n, b) for n, b in balances]
    decisions = authorize(*frames(frame, tx, accounts), "serial")
    assert {r[0] for r in accepted(decisions).select("id_transaccion").collect()} == one_by_one(tx, accounts, "serial")[0]


def test_a_group_too_large_goes_to_the_rounds_beside_small_ones(frame, monkeypatch):
    monkeypatch.setattr(ledger, "ONE_GROUP_LEGS", 0)
    monkeypatch.setattr(ledger, "GROUP_LEGS", 60)
    monkeypatch.setattr(ledger, "slice_count", lambda _: 8)
    tx, accounts = [], []
    for i, (part, count) in enumerate({"p": 20, "q": 250, "r": 20}.items()):
        own, balances = random_case(5 + i, count, 8, 0.4)
        tx += [(3 * k + i, part + o, part + d, m) for k, o, d, m in own]
        accounts += [(part + n, b / 10) for n, b in balances]
    accounts = [(n, round(b, 2)) for n, b in accounts]
    decisions = authorize(*frames(frame, tx, accounts), "serial")
    assert {r[0] for r in accepted(decisions).select("id_transaccion").collect()} == one_by_one(tx, accounts, "serial")[0]


@pytest.mark.parametrize("few", [0, 60, 1000])
def test_groups_by_rounds_and_by_one_task(spark, monkeypatch, few):
    monkeypatch.setattr(components, "FEW_LINKS", few)
    links = [(f"c{i // 40}n{i:04d}", f"c{i // 40}n{i + 1:04d}") for i in range(400) if i % 40 < 39]
    got = {r.miembro: r.grupo for r in linked_groups(spark.createDataFrame(links, "a string, b string"), "a", "b").collect()}
    assert len(got) == 400 and len(set(got.values())) == 10
    assert all(name.split("n")[0] == group.split("n")[0] and group in got for name, group in got.items())
