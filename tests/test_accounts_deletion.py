import pytest
from pyspark.sql import functions as F

from caudal.operators import accounts
from caudal.operators.deletion import delete_blockers, delete_rows
from caudal.schemas import TABLES
from conftest import rows

ACCOUNTS = "no_cuenta string; tipo_cuenta string; saldo decimal(12,2); id_cliente long"
BATCH = (
    "orden long; nombre string; apellido_p string; apellido_m string; curp string; correo string;"
    "tipo_cuenta string; saldo_inicial decimal(12,2)"
)


@pytest.mark.parametrize(
    "kind, before, after",
    [
        ("Corriente", "49.99", "49.99"),
        ("Corriente", "50.00", "0.00"),
        ("Corriente", "999.99", "949.99"),
        ("Corriente", "1000.00", "1000.00"),
        ("Corriente", "-10.00", "-10.00"),
        ("Ahorro", "500.00", "500.00"),
        (None, "500.00", "500.00"),
        ("Corriente", None, None),
    ],
)
def test_fee_bounds(frame, kind, before, after):
    got = accounts.month_end_fee(frame([("a", kind, before, 1)], ACCOUNTS)).first()["saldo"]
    assert (None if got is None else str(got)) == after


def test_loans(frame):
    loans = frame(
        [(1, "Pendiente", "10", 1), (2, "Pendiente", "20", 1), (3, "Pagado", "30", 1), (4, "Pendiente", "40", 2)],
        "id_prestamo long; estado string; monto decimal(12,2); id_cliente long",
    )
    cuenta = frame([("b", "Ahorro", "1", 1), ("a", "Ahorro", "2", 1)], ACCOUNTS)
    asked = frame([(i,) for i in (1, 1, 2, 3, 4, 5)], "id_prestamo long")
    out = accounts.authorize_loans(loans, cuenta, asked)
    assert {r["id_prestamo"]: r["estado"] for r in out.prestamo.collect()} == {
        1: "Aprobado", 2: "Aprobado", 3: "Pagado", 4: "Pendiente",
    }
    assert {r["no_cuenta"]: str(r["saldo"]) for r in out.cuenta.collect()} == {"a": "32.00", "b": "1.00"}
    assert rows(out.rejected) == sorted(
        [(3, accounts.LOAN_NOT_PENDING), (4, accounts.LOAN_NO_ACCOUNT), (5, accounts.LOAN_NOT_PENDING)], key=repr
    )


def test_a_refused_row_leaves_nothing_behind(frame, sample):
    """Chains: a row is refused, so the next holder of its value is taken, and so on."""
    taken = sample["cliente"].first()
    batch = frame(
        [
            (1, "n", "p", "m", "NEWC1", taken["correo"], "Ahorro", "1"),
            (2, "n", "p", "m", "NEWC1", "fresh@x", "Ahorro", "1"),
            (3, "n", "p", "m", "OTHR2", "fresh@x", "Ahorro", "1"),
            (4, "n", "p", "m", "OTHR2", "more@x", "Ahorro", "1"),
            (5, "n", "p", "m", "LAST3", "more@x", "Ahorro", "1"),
            (6, "n", "p", "m", "LAST3", "end@x", "Ahorro", "1"),
        ],
        BATCH,
    )
    out = accounts.register_clients(batch, sample["cliente"], sample["cuenta"])
    assert {r["orden"]: r["motivo"] for r in out.rejected.collect()} == {
        1: accounts.MAIL_TAKEN, 3: accounts.MAIL_TAKEN, 5: accounts.MAIL_TAKEN,
    }


def test_a_taken_number_is_drawn_again(frame, sample, spark):
    batch = frame([(1, "n", "p", "m", "AAAA1", "uno@x", "Ahorro", "1"), (2, "n", "p", "m", "BBBB2", "dos@x", "Ahorro", "1")], BATCH)
    first = accounts.register_clients(batch, sample["cliente"], sample["cuenta"]).cuenta
    used = sample["cuenta"].unionByName(first.where("no_cuenta LIKE 'AAAA%'").select(*sample["cuenta"].columns))
    again = {r["no_cuenta"][:4]: r["no_cuenta"] for r in accounts.register_clients(batch, sample["cliente"], used).cuenta.collect()}
    before = {r["no_cuenta"][:4]: r["no_cuenta"] for r in first.collect()}
    assert again["BBBB"] == before["BBBB"] and again["AAAA"] != before["AAAA"]


def test_registration(frame, sample):
    taken = sample["cliente"].first()
    batch = frame(
        [
            (1, "n", "p", "m", "AAAA1", "uno@x", "Ahorro", "10"),
            (2, "n", "p", None, "BBBB2", "dos@x", "Nomina", None),
            (3, "n", "p", "m", "AAAA1", "tres@x", "Ahorro", "10"),
            (4, "n", "p", "m", "CCCC3", "dos@x", "Ahorro", "10"),
            (5, "n", "p", "m", taken["curp"], "cinco@x", "Ahorro", "10"),
            (6, "n", "p", "m", "DDDD4", taken["correo"], "Ahorro", "10"),
            (7, None, "p", "m", "EEEE5", "siete@x", "Ahorro", "10"),
            (8, "n", "p", "m", "FFFF6", "ocho@x", "Ahorro", "10"),
        ],
        BATCH,
    )
    out = accounts.register_clients(batch, sample["cliente"], sample["cuenta"])
    top = sample["cliente"].agg(F.max("id_cliente")).first()[0]
    new = {r["curp"]: r for r in out.cliente.collect()}
    assert {c: r["id_cliente"] for c, r in new.items()} == {"AAAA1": top + 1, "BBBB2": top + 2, "FFFF6": top + 3}
    assert new["AAAA1"]["apellido"] == "p m" and new["BBBB2"]["apellido"] == "p"
    assert new["AAAA1"]["ciudad"] == "Ciudad de México"
    opened = {r["id_cliente"]: r for r in out.cuenta.collect()}
    assert str(opened[top + 2]["saldo"]) == "0.00"
    assert opened[top + 1]["no_cuenta"][:4] == "AAAA" and 100000 <= int(opened[top + 1]["no_cuenta"][4:]) <= 999999
    assert {r["orden"]: r["motivo"] for r in out.rejected.collect()} == {
        3: accounts.CURP_TAKEN, 4: accounts.MAIL_TAKEN, 5: accounts.CURP_TAKEN, 6: accounts.MAIL_TAKEN,
        7: accounts.MISSING_VALUE,
    }
    assert out.cliente.columns == TABLES["cliente"].schema.fieldNames()
    # A second attempt draws another number, the same one each time.
    again = [accounts.register_clients(batch, sample["cliente"], sample["cuenta"], 1).cuenta for _ in range(2)]
    assert rows(again[0]) == rows(again[1]) != rows(out.cuenta)


def test_owner_sees_own_accounts_only(sample):
    mine = accounts.accounts_of(sample["cuenta"], sample["cliente"], "CURP00000000000003")
    assert [r["curp"] for r in mine.collect()] == ["CURP00000000000003"]
    assert accounts.accounts_of(sample["cuenta"], sample["cliente"]).count() == 0


def small(frame):
    t = {name: None for name in TABLES}
    t["cliente"] = frame([(1,), (2,), (3,)], "id_cliente long")
    t["cliente_tel"] = frame([("t1", 1), ("t2", 2), ("t3", 2)], "tel string; id_cliente long")
    t["cliente_biometria"] = frame([(1, 2)], "id_biometria long; id_cliente long")
    t["cuenta"] = frame([("a", 1), ("b", 1), ("c", 1)], "no_cuenta string; id_cliente long")
    t["prestamo"] = frame([(1, 3)], "id_prestamo long; id_cliente long")
    t["tarjeta"] = frame([("k1", "a"), ("k2", "a")], "no_tarjeta string; no_cuenta string")
    t["transaccion"] = frame(
        [(1, "k1", "a", "b"), (2, "k2", "a", "b"), (3, None, "a", "b")],
        "id_transaccion long; no_tarjeta string; cuenta_origen string; cuenta_destino string",
    )
    t["beneficiario"] = frame([(1, "c"), (2, "a")], "id_beneficiario long; no_cuenta string")
    t["beneficiario_tel"] = frame([("x", 1), ("y", 2)], "tel string; id_beneficiario long")
    return t


def test_client_goes_with_phones_and_biometrics_unless_held(frame):
    t = small(frame)
    out = delete_rows(t, "cliente", t["cliente"])
    assert rows(out.blockers) == [(1, "cuenta", "id_cliente", 3), (3, "prestamo", "id_cliente", 1)]
    assert rows(out.tables["cliente"]) == [(1,), (3,)]
    assert rows(out.tables["cliente_tel"]) == [("t1", 1)]
    assert out.tables["cliente_biometria"].count() == 0


def test_account_takes_beneficiaries_and_their_phones(frame):
    t = small(frame)
    out = delete_rows(t, "cuenta", t["cuenta"])
    held = {(r["clave"], r["tabla"], r["columna"], r["filas"]) for r in out.blockers.collect()}
    assert held == {
        ("a", "tarjeta", "no_cuenta", 2), ("a", "transaccion", "cuenta_origen", 3), ("b", "transaccion", "cuenta_destino", 3),
    }
    assert {r["no_cuenta"] for r in out.tables["cuenta"].collect()} == {"a", "b"}
    assert [r["id_beneficiario"] for r in out.tables["beneficiario"].collect()] == [2]
    assert [r["tel"] for r in out.tables["beneficiario_tel"].collect()] == ["y"]


def test_card_leaves_its_transactions_without_card(frame):
    t = small(frame)
    out = delete_rows(t, "tarjeta", t["tarjeta"].where("no_tarjeta = 'k1'"))
    assert delete_blockers(t, "tarjeta", t["tarjeta"]).count() == 0
    assert {r["id_transaccion"]: r["no_tarjeta"] for r in out.tables["transaccion"].collect()} == {1: None, 2: "k2", 3: None}
    assert out.tables["transaccion"].columns == t["transaccion"].columns
