from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from caudal.functions.masking import mask_card, mask_digits, mask_mail_user
from caudal.functions.money import cents, from_cents, mean, money_text
from caudal.operators import gold, silver
from conftest import rows


@pytest.mark.parametrize(
    "mail, shown",
    [("ana@x.mx", "xxxxxx@x.mx"), ("sin arroba", "xxxxxx"), ("@x.mx", "@x.mx"), (None, None), ("a@b@c", "xxxxxx@b@c")],
)
def test_mail_mask(spark, mail, shown):
    df = spark.createDataFrame([(mail,)], "m string").select(mask_mail_user(F.col("m")))
    assert df.first()[0] == shown


def test_digit_and_card_masks(spark):
    df = spark.createDataFrame([("+52 5501", "4152123412341234"), (None, None), ("", "123")], "a string, b string")
    got = [tuple(r) for r in df.select(mask_digits(F.col("a")), mask_card(F.col("b"))).collect()]
    assert got == [("+XX XXXX", "XXXXXXXXXXXX1234"), (None, None), ("", "123")]


def test_clients_keep_every_phone_and_show_no_digit(spark, frame):
    clients = frame(
        [(i, f"n{i}", "ñandú", f"c{i}@x", "d", "s") for i in range(1, 4)],
        "id_cliente long; nombre string; apellido string; correo string; delegacion string; estado_civil string",
    )
    phones = [(f"55{n:08d}", 1) for n in range(500)] + [("+52 1", 1), (None, 1), ("123", 2), ("12", 2)]
    got = {r["id_cliente"]: r for r in silver.dim_clientes(clients, frame(phones, "tel string; id_cliente long")).collect()}
    assert got[1]["telefonos"].split(",") == ["+XX X", *["X" * 10] * 500]
    assert got[2]["telefonos"] == "XX,XXX"
    assert got[3]["telefonos"] == ""
    assert (got[1]["nombre"], got[1]["apellido"], got[1]["correo"]) == ("N1", "ÑANDÚ", "xxxxxx@x")
    assert not any(c.isdigit() for r in got.values() for c in r["telefonos"])


def test_beneficiaries_use_their_own_separator(spark, frame):
    who = frame(
        [(1, "Madre", "a", "b", "100.00", "c1")],
        "id_beneficiario long; parentesco string; nombre string; apellido string; porcentaje_saldo decimal(5,2); no_cuenta string",
    )
    phones = frame([("11", 1), ("22", 1)], "tel string; id_beneficiario long")
    assert silver.dim_beneficiarios(who, phones).first()["telefonos_beneficiario"] == "XX, XX"


def test_fact_keeps_transactions_without_account(spark, frame):
    tx = frame(
        [(1, "k", "d", "a1", "5", "Retiro", "2024-01-01 00:00:00"), (2, "k", "d", None, "5", "Retiro", None)],
        "id_transaccion long; no_tarjeta string; cuenta_destino string; cuenta_origen string; monto decimal(16,2);"
        "tipo_movimiento string; fecha_transaccion timestamp_ntz",
    )
    accounts = frame([("a1", "Ahorro", "10", 7)], "no_cuenta string; tipo_cuenta string; saldo decimal(12,2); id_cliente long")
    fact = silver.fact_transacciones(tx, accounts)
    assert [(r["id_transaccion"], r["id_cliente"]) for r in fact.orderBy("id_transaccion").collect()] == [(1, 7), (2, None)]
    assert silver.pivot_model_credit(tx, accounts).count() == 2


def test_masked_cards_are_optional(sample):
    plain = silver.dim_tarjetas(sample["tarjeta"])
    hidden = silver.dim_tarjetas(sample["tarjeta"], mask_cards=True)
    assert plain.columns == hidden.columns
    assert plain.first()["cvv"].isdigit() and hidden.first()["cvv"] == "XXX"


def test_kpi_of_nothing(spark, sample):
    nothing = gold.kpi_capital(sample["cuenta"].where("false")).first()
    assert tuple(nothing) == (None, None, None)
    assert gold.kpi_movimientos(sample["transaccion"].where("false")).count() == 0


def test_kpi_types_and_order(sample):
    months = gold.kpi_movimientos(sample["transaccion"])
    assert dict(months.dtypes)["monto_total"] == "decimal(26,2)"
    keys = [(r["periodo"], r["tipo_movimiento"]) for r in months.collect()]
    assert keys == sorted(keys)


@pytest.mark.parametrize(
    "amount, text",
    [
        ("6612744.62", "$   6,612,744.62"),
        ("-12.50", "$         -12.50"),
        ("0.50", "$            .50"),
        ("123456789012.00", "$123,456,789,012.00"),
        (None, None),
    ],
)
def test_money_text(spark, amount, text):
    df = spark.createDataFrame([(amount,)], "a string").select(F.col("a").cast("decimal(20,2)").alias("a"))
    assert df.select(money_text(F.col("a"), 15)).first()[0] == text


def test_cents_round_trip(spark):
    df = spark.createDataFrame([(Decimal("-12.34"),), (Decimal("99999999999999.99"),)], "a decimal(16,2)")
    assert rows(df.select(from_cents(cents(F.col("a"))))) == rows(df)


def test_mean_of_no_rows(spark):
    df = spark.range(1).select(mean(F.lit(None).cast("decimal(10,2)"), F.lit(0).cast("long")))
    assert df.first()[0] is None


def test_top_delegaciones_breaks_ties_by_name(spark):
    df = spark.createDataFrame([(d,) for d in "ddccbbaa"], "delegacion string")
    assert [r["delegacion"] for r in gold.report_top_delegaciones(df).collect()] == ["a", "b", "c"]


def test_all_management_reports_answer(sample):
    assert all(df.count() > 0 for df in gold.management_reports(sample).values())
