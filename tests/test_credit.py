import pytest

from caudal.operators import credit
from caudal.operators.silver import pivot_model_credit
from conftest import rows


def ledger(frame):
    tx = frame(
        [
            (1, "a", "100", "Deposito", "2024-06-30 12:00:00"),
            (2, "a", "40", "Retiro", "2024-04-01 12:00:00"),  # exactly 90 days earlier
            (3, "b", "1", "Retiro", "2024-04-01 11:59:59"),  # one second too old
            (4, "c", "5", None, "2024-06-30 12:00:00"),
            (5, "none", "7", "Deposito", "2024-06-30 12:00:00"),
        ],
        "id_transaccion long; cuenta_origen string; monto decimal(16,2); tipo_movimiento string; fecha_transaccion timestamp_ntz",
    )
    accounts = frame(
        [("a", "x", "10", 1), ("b", "x", "30", 1), ("c", "x", "50", 2)],
        "no_cuenta string; tipo_cuenta string; saldo decimal(12,2); id_cliente long",
    )
    return tx, accounts


def test_features_by_hand(frame):
    tx, accounts = ledger(frame)
    got = {r["id_cliente"]: r for r in credit.client_features(pivot_model_credit(tx, accounts)).collect()}
    assert set(got) == {0, 1, 2}
    one, two, nobody = got[1], got[2], got[0]
    assert one[credit.MEAN_BALANCE] == 10.0  # account a twice, account b not at all
    assert (one["total_ingresos"], one["total_egresos"], one[credit.NET_VOLUME], one[credit.USES]) == (100, 41, 59, 3)
    assert (two["total_ingresos"], two["total_egresos"], two[credit.MEAN_BALANCE]) == (0, 0, 50.0)
    assert (nobody[credit.MEAN_BALANCE], nobody["total_ingresos"], nobody[credit.USES]) == (0.0, 7, 1)


def test_both_ways_to_the_features_agree(frame, sample):
    for tx, accounts in (ledger(frame), (sample["transaccion"], sample["cuenta"])):
        direct = credit.client_features_from_ledger(tx, accounts)
        stored = credit.client_features(pivot_model_credit(tx, accounts))
        assert direct.columns == stored.columns
        assert rows(direct) == rows(stored)


def test_label_and_line(frame):
    tx, accounts = ledger(frame)
    labelled = credit.with_label(credit.client_features_from_ledger(tx, accounts))
    got = {r["cliente_id"]: tuple(r)[1:] for r in credit.credit_line_by_label(labelled).collect()}
    assert got[1] == (1, 12.0)
    assert got[2] == (0, pytest.approx(50.5))


def test_model_scores_everyone(sample):
    features = credit.client_features_from_ledger(sample["transaccion"], sample["cuenta"])
    model = credit.train(features)
    lines = model.credit_lines()
    assert lines.columns == ["cliente_id", "credit_aprobado", credit.CREDIT_LINE]
    assert lines.count() == features.count()
    assert model.auc > 0.95
    assert abs(sum(model.importances.values()) - 1) < 1e-6 and set(model.importances) == set(credit.FEATURES)
    again = credit.train(features)
    assert rows(again.credit_lines()) == rows(lines)


def test_holdout_and_fewer_inputs(sample):
    features = credit.client_features_from_ledger(sample["transaccion"], sample["cuenta"])
    model = credit.train(features, inputs=(credit.MEAN_BALANCE, credit.USES), holdout=0.3)
    assert set(model.importances) == {credit.MEAN_BALANCE, credit.USES}
    assert 0 <= model.auc <= 1 and model.scored.count() == features.count()
