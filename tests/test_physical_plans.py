"""The plans are the ones we want: pruned scans, one shuffle of the fact, no one-task stage, no Python."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as e
from caudal.operators import credit, deletion, extracts, ledger, silver
from caudal.operators.gold import kpi_movimientos
from conftest import SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def stored(spark, sample):
    """Tables read from files, so that scans show."""
    from caudal.session import materialise

    return {n: materialise(sample[n]) for n in ("transaccion", "cuenta", "tarjeta", "cliente", "prestamo", "beneficiario")}


IN_PYTHON = {"tx_authorize_running", "tx_authorize_serial", "tx_post_stream", "ml_metrics"}


@pytest.mark.parametrize("key", sorted(set(e.QUERIES) - IN_PYTHON))
def test_no_python_in_the_plan(spark, key):
    text = plan(e.queries()[key](spark, SMALL))
    assert "Python" not in text and "InPandas" not in text and "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_scan_reads_only_what_the_kpi_needs(stored):
    text = plan(kpi_movimientos(stored["transaccion"]))
    schema = text[text.index("ReadSchema") :]
    assert "cuenta_origen" not in schema and "no_tarjeta" not in schema
    assert "fecha_transaccion" in schema and "SinglePartition" not in text


def test_filters_reach_the_scan(stored):
    text = plan(ledger.rejected(ledger.authorize_opening(stored["transaccion"], stored["cuenta"].where("saldo < 0"))))
    assert "PushedFilters: [IsNotNull(saldo), LessThan(saldo" in text


def test_wide_extract_shuffles_transactions_once(stored, no_broadcast):
    tables = {
        "transacciones": stored["transaccion"], "cuentas": stored["cuenta"], "tarjetas": stored["tarjeta"],
        "clientes": stored["cliente"], "prestamos": stored["prestamo"], "beneficiarios": stored["beneficiario"],
    }
    text = plan(extracts.full_transactions(tables))
    moved = [line for line in text.splitlines() if "Exchange" in line]
    assert "SinglePartition" not in text
    # Children print below their exchange: count the exchanges above the one scan of transactions.
    lines = text.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and "id_transaccion" in line)
    depth = [len(line) - len(line.lstrip(" :+-*()0123456789")) for line in lines]
    above, limit = [], depth[at]
    for i in range(at, -1, -1):
        if depth[i] < limit:
            limit = depth[i]
            above.append(lines[i])
    assert sum("Exchange" in line for line in above) == 1, moved


def test_tiling_has_no_one_task_sort(stored):
    tables = {
        "transacciones": stored["transaccion"], "cuentas": stored["cuenta"], "tarjetas": stored["tarjeta"],
        "clientes": stored["cliente"], "prestamos": stored["prestamo"], "beneficiarios": stored["beneficiario"],
    }
    text = plan(extracts.tiled_transactions(tables))
    main = text[: text.index("Subquery")] if "Subquery" in text else text
    assert "Window" not in main and "Exchange" not in main
    assert "SinglePartition" in plan(extracts.tiled_transactions(tables, method="window"))


def scans(df):
    """Scans of files in the plan; a scan that a later one reuses counts once."""
    return plan(df).count("FileScan")


def test_wide_extract_reads_every_table_once(spark, no_broadcast):
    e_tables = {n: silver_tables_small(spark)[n] for n in ("transacciones", "cuentas", "tarjetas", "clientes", "prestamos", "beneficiarios")}
    assert scans(extracts.full_transactions(e_tables)) <= 17
    moved = [line for line in plan(extracts.full_transactions(e_tables)).splitlines() if "REPARTITION" in line]
    assert not moved


def test_the_full_report_reads_a_table_twice(spark, sample, no_broadcast):
    from caudal.operators import quality
    from caudal.schemas import TABLES
    from caudal.session import materialise

    tables = {n: materialise(sample[n]) for n in TABLES}
    assert scans(quality.quality_report(tables)) <= 2 * len(TABLES)
    assert scans(quality.reference_failures(tables)) <= len(TABLES)
    text = plan(quality.reference_failures(tables))
    assert sum("Exchange hashpartitioning(dominio" in line and "valor" in line for line in text.splitlines()) == 1


def silver_tables_small(spark):
    from caudal.operators.silver import silver_tables
    from caudal.plans.extracts import bundle
    from caudal.sources.sample import SampleTables

    return bundle(silver_tables(SampleTables(spark, SMALL)))


def test_features_meet_accounts_after_adding_up(stored, no_broadcast):
    text = plan(credit.client_features_from_ledger(stored["transaccion"], stored["cuenta"]))
    join = text.index("Join")
    assert "HashAggregate" in text[join:], "transactions are aggregated below the join"
    assert "partial_sum" in text


def test_client_join_is_not_there(stored):
    assert plan(silver.pivot_model_credit(stored["transaccion"], stored["cuenta"])).count("FileScan") == 2


@pytest.fixture
def small_skew(spark, no_broadcast):
    """Thresholds at which the sample's hot account counts as skewed."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def hot_tables(stored):
    """A third of the transactions and of the beneficiaries hang on one account."""
    hot = F.lit("000000000001")
    tx = stored["transaccion"].repartition(8)
    third = F.pmod(F.xxhash64("id_transaccion"), F.lit(3)) == 0
    shares = stored["beneficiario"]
    return {
        "transacciones": tx.withColumn("cuenta_origen", F.when(third, hot).otherwise(F.col("cuenta_origen"))),
        "cuentas": stored["cuenta"],
        "tarjetas": stored["tarjeta"],
        "clientes": stored["cliente"],
        "prestamos": stored["prestamo"],
        "beneficiarios": shares.withColumn("no_cuenta", F.when(F.col("id_beneficiario") % 3 == 0, hot).otherwise(F.col("no_cuenta"))),
    }


def test_a_hot_account_is_split(stored, small_skew):
    tables = hot_tables(stored)
    third = F.pmod(F.xxhash64("id_transaccion"), F.lit(3)) == 0
    card = F.when(third, F.lit("4152000000000001")).otherwise(F.col("no_tarjeta"))
    one_card = {**stored, "transaccion": stored["transaccion"].repartition(8).withColumn("no_tarjeta", card)}
    for df in (
        silver.fact_transacciones(tables["transacciones"], tables["cuentas"]),
        ledger.authorize_opening(tables["transacciones"], tables["cuentas"]),
        extracts.wide_transactions(tables),
        extracts.full_transactions(tables),
        extracts.full_transactions(tables, card_key="no_tarjeta"),
        deletion.delete_rows(one_card, "tarjeta", stored["tarjeta"].where("no_tarjeta = '4152000000000001'")).tables["transaccion"],
    ):
        df.collect()
        assert "skew=true" in plan(df)
