"""Queries over the sample tables, one per operator, and the SQL that checks them."""

from __future__ import annotations

import os
import sys
import tempfile
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from caudal.operators import accounts, changes, credit, deletion, extracts, gold, ledger, quality, silver  # noqa: E402
from caudal.plans.audit import QualityStore, run_sql  # noqa: E402
from caudal.plans.extracts import bundle, extract_tiles, extract_wide  # noqa: E402
from caudal.plans.lakehouse import Lake  # noqa: E402
from caudal.plans.scoring import read_scores, score  # noqa: E402
from caudal.schemas import TABLES  # noqa: E402
from caudal.session import CHECKPOINT_KEY, materialise, work_dir  # noqa: E402
from caudal.sources.files import (  # noqa: E402
    join_path, read_csv, read_parquet, snapshot, write_bundle, write_csv, write_facts, write_parquet,
)
from caudal.sources.sample import SampleTables  # noqa: E402
from caudal.streaming.posting import LedgerState, stream_postings  # noqa: E402
import oracles  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

SAMPLE_DIR = "/root/testdata/sf0.001"
ARRIVALS = 4

ENROLMENTS = """
SELECT c_custkey * 2 AS orden, concat('Nombre', c_custkey) AS nombre, 'Paterno' AS apellido_p, 'Materno' AS apellido_m,
       CASE WHEN c_custkey % 10 = 0 THEN concat('CURP', lpad(c_custkey, 14, '0'))
            ELSE concat(char(65 + c_custkey % 26), 'LTA', lpad(c_custkey, 14, '0')) END AS curp,
       concat('alta', c_custkey - c_custkey % 7 % 2, '@correo.example') AS correo,
       'Ahorro' AS tipo_cuenta, CAST(c_acctbal AS DECIMAL(12,2)) AS saldo_inicial
FROM {customer}"""


def entry(spark: SparkSession) -> DataFrame:
    """Transactions and amounts by month and movement type."""
    return gold.kpi_movimientos(SampleTables(spark, SAMPLE_DIR)["transaccion"])


def _on_tables(build: Callable[[SampleTables], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(SampleTables(spark, sf_dir))


def _silver(t: SampleTables) -> dict[str, DataFrame]:
    return bundle(silver.silver_tables(t))


def _bronze(t: SampleTables) -> Lake:
    lake = Lake(t.spark, work_dir(t.spark))
    lake.ingest(lambda name: t[name])
    return lake


def _csv_roundtrip(t: SampleTables) -> DataFrame:
    path = work_dir(t.spark)
    wide = extracts.wide_transactions(_silver(t))
    write_csv(wide, path)
    return read_csv(t.spark, path, wide.schema)


def _tiles_by(card_key: str) -> Callable[[SampleTables], DataFrame]:
    return lambda t: extracts.tiled_transactions(_silver(t), card_key=card_key)


def _refined(t: SampleTables) -> Lake:
    """Bronze, Silver with the fact laid out by month, and Gold, all written."""
    lake = _bronze(t)
    lake.refine(partition_fact=True)
    lake.publish()
    return lake


def _layer_table(name: str) -> Callable[[SampleTables], DataFrame]:
    """A table of Silver or Gold as it is read back once both layers are written."""
    return lambda t: _refined(t).gold(name) if name.startswith("kpi_") else _refined(t).silver()[name]


def _silver_lake(t: SampleTables) -> Lake:
    lake = Lake(t.spark, work_dir(t.spark))
    write_bundle(silver.silver_tables(t), lake.silver_root)
    return lake


def _facts_roundtrip(t: SampleTables) -> DataFrame:
    root = work_dir(t.spark)
    write_facts({"transacciones": _silver(t)["transacciones"]}, root)
    return read_parquet(t.spark, join_path(root, "fact_transacciones"))


def _etl_wide_files(t: SampleTables) -> DataFrame:
    """The extract as four CSV files, read back with their number."""
    wide = read_csv(t.spark, extract_wide(_silver_lake(t), files=4), extracts.wide_transactions(_silver(t)).schema)
    files = wide.select(F.input_file_name().alias("f")).agg(F.countDistinct("f").alias("n")).scalar()
    return wide.withColumn("archivos", files)


def _tiles_csv_roundtrip(t: SampleTables) -> DataFrame:
    schema = extracts.full_transactions(_silver(t)).schema.add(extracts.TILE, "integer")
    return read_csv(t.spark, extract_tiles(_silver_lake(t)), schema)


def _snapshot_roundtrip(t: SampleTables) -> DataFrame:
    """Every table exported; what the export holds, by table, with the sum of its balances or amounts."""
    folder = snapshot({name: t[name] for name in TABLES}, work_dir(t.spark))
    money = {"cuenta": "saldo", "transaccion": "monto", "prestamo": "monto"}
    counts = [
        read_parquet(t.spark, join_path(folder, name)).agg(
            F.lit(name).alias("tabla"),
            F.count(F.lit(1)).alias("filas"),
            F.sum(F.col(money[name]).cast("decimal(18,2)") if name in money else F.lit(0).cast("decimal(18,2)")).alias("importe"),
        )
        for name in TABLES
    ]
    return reduce(DataFrame.unionByName, counts)


def _kpi_sql(t: SampleTables) -> DataFrame:
    text = """SELECT 'delegacion' AS reporte, delegacion AS grupo, count(*) AS total FROM cliente GROUP BY delegacion
      UNION ALL SELECT 'movimiento', tipo_movimiento, count(*) FROM transaccion GROUP BY tipo_movimiento"""
    return run_sql(t.spark, text, {"cliente": t["cliente"], "transaccion": t["transaccion"]})


def _kpi_sql_money(t: SampleTables) -> DataFrame:
    """The two reports on money as SQL text, in whole cents; a mean is rounded half up."""
    text = """SELECT 'capital' AS reporte, CAST(sum(saldo * 100) AS BIGINT) AS centavos FROM cuenta
      UNION ALL SELECT 'promedio', (2 * s + n) DIV (2 * nullif(n, 0))
      FROM (SELECT CAST(sum(monto * 100) AS BIGINT) AS s, count(monto) AS n FROM transaccion)"""
    return run_sql(t.spark, text, {"cuenta": t["cuenta"], "transaccion": t["transaccion"]})


def _score_check(t: SampleTables) -> DataFrame:
    """The stored scores: every client once, and the line that follows from its own prediction."""
    lake = _silver_lake(t)
    model = score(lake)
    own = _features(t).select(F.col("id_cliente").alias("cliente_id"), F.col(credit.MEAN_BALANCE).alias("m"))
    both = lake.gold("ml_credit_score").join(own, "cliente_id", "full")
    line = F.col("m") * F.when(F.col("credit_aprobado") == 1, F.lit(1.2)).otherwise(F.lit(1.01))
    return both.agg(
        F.count("credit_aprobado").alias("clientes"),
        F.countDistinct("cliente_id").alias("distintos"),
        F.count_if(F.col(credit.CREDIT_LINE) == line).alias("lineas_correctas"),
        F.count_if(~F.col("credit_aprobado").isin(0, 1)).alias("fuera_de_rango"),
    ).withColumn("auc_alta", F.lit(model.auc >= 0.95))


def _dq_incremental(t: SampleTables) -> DataFrame:
    """The full report from the tallies of four arrivals; each table's rows arrive by a hash of their key."""
    store = QualityStore(t.spark, work_dir(t.spark))
    tables = {name: t[name] for name in TABLES}
    for i in range(ARRIVALS):
        turn = {n: F.pmod(F.xxhash64(spec.key), F.lit(ARRIVALS)) == i for n, spec in TABLES.items()}
        store.add(i, {n: df.where(turn[n]) for n, df in tables.items()})
    return store.report(range(ARRIVALS))


def _my_accounts(t: SampleTables) -> DataFrame:
    # The principal is the last client with an account.
    principal = t["cliente"].join(t["cuenta"], "id_cliente", "left_semi").agg(F.max("curp").alias("p")).scalar()
    return accounts.accounts_of(t["cuenta"], t["cliente"], principal)


def _authorize(mode: str) -> Callable[[SampleTables], DataFrame]:
    return lambda t: ledger.authorize(t["transaccion_escalada"], t["cuenta"], mode)


def _post_stream(t: SampleTables) -> DataFrame:
    """Post the transactions as they arrive in id order, and return the balances they leave."""
    spark = t.spark
    root, arrivals = work_dir(spark), work_dir(spark)
    state = LedgerState(spark, root)
    state.open(t["cuenta"])
    tx = t["transaccion_escalada"]
    last = tx.agg(F.max("id_transaccion")).first()[0]
    step = last // ARRIVALS + 1
    for i in range(ARRIVALS):
        part = tx.where((F.col("id_transaccion") >= i * step) & (F.col("id_transaccion") < (i + 1) * step))
        part.write.mode("append").parquet(arrivals)
        # Each start goes on from the checkpoint of the one before and takes what has arrived as one batch.
        query = stream_postings(spark, arrivals, state)
        query.awaitTermination()
    return state.balances_after(query.lastProgress["batchId"])


def _loans(t: SampleTables) -> accounts.LoanOutcome:
    return accounts.authorize_loans(t["prestamo"], t["cuenta"], t["prestamo"])


def _enrolled(t: SampleTables) -> accounts.Registration:
    batch = t.spark.sql(ENROLMENTS, customer=t["customer"])
    return accounts.register_clients(batch, t["cliente"], t["cuenta"])


def _delete_cascade(t: SampleTables) -> DataFrame:
    """Delete every client the rules let go; list what is left."""
    left = deletion.delete_rows(t, "cliente", t["cliente"]).tables
    names = ("cliente", "cliente_tel", "cliente_biometria")
    rows = [
        left[n].select(F.lit(n).alias("tabla"), F.col(TABLES[n].key).cast("string").alias("clave")) for n in names
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def _delete_set_null(t: SampleTables) -> DataFrame:
    """Delete every expired card; the transactions made with them lose their card."""
    left = deletion.delete_rows(t, "tarjeta", t["tarjeta"].where("estado = 'Vencida'")).tables
    return left["transaccion"].select("id_transaccion", "no_tarjeta")


def _features(t: SampleTables) -> DataFrame:
    return credit.client_features_from_ledger(t["transaccion"], t["cuenta"])


def _lines(t: SampleTables) -> DataFrame:
    return credit.credit_line_by_label(credit.with_label(_features(t)))


def _score_preview(t: SampleTables) -> DataFrame:
    """The head of the stored credit lines, and how many are stored."""
    lake = Lake(t.spark, work_dir(t.spark))
    write_parquet(_lines(t), join_path(lake.gold_root, "ml_credit_score"))
    first, total = read_scores(lake)
    return first.withColumn("total", F.lit(total).cast("long"))


def _bronze_roundtrip(t: SampleTables) -> DataFrame:
    path = join_path(work_dir(t.spark), "transaccion.parquet")
    write_parquet(t["transaccion"], path)
    return t.spark.read.schema(TABLES["transaccion"].schema).parquet(path)


def _later_accounts(t: SampleTables) -> DataFrame:
    """The accounts some time on: some closed, some with another balance, and some new."""
    cuenta = t["cuenta"]
    moved = F.when(F.col("id_cliente") % 5 == 0, F.col("saldo") + 1).otherwise(F.col("saldo")).cast("decimal(12,2)")
    kept = cuenta.where(F.col("id_cliente") % 17 != 0).withColumn("saldo", moved)
    fresh = cuenta.where(F.col("id_cliente") % 13 == 0).withColumn("no_cuenta", F.concat(F.lit("9"), F.substring("no_cuenta", 2, 11)))
    return kept.unionByName(fresh)


def _bronze_apply(t: SampleTables) -> DataFrame:
    """Bronze brought up to the later accounts, read back."""
    lake = _bronze(t)
    lake.sync(lambda name: _later_accounts(t), ["cuenta"])
    return lake.bronze()["cuenta"]


def _auc_exact(t: SampleTables) -> DataFrame:
    """How well the mean balance ranks clients by the label, over stored scores."""
    scores = materialise(credit.with_label(_features(t)).select(F.col(credit.MEAN_BALANCE).alias("puntaje"), "label"))
    return credit.auc_by_ranks(scores, "puntaje", "label")


QUERIES: dict[str, Callable[[SampleTables], DataFrame]] = {
    "bronze_roundtrip": _bronze_roundtrip,
    "bronze_changes": lambda t: changes.compare(t["cuenta"], _later_accounts(t), "no_cuenta").keys,
    "bronze_apply": _bronze_apply,
    "bronze_counts": lambda t: _bronze(t).bronze_counts(),
    "csv_roundtrip": _csv_roundtrip,
    "silver_layer": lambda t: _refined(t).silver()["dim_fact_transacciones"],
    "gold_layer": lambda t: _refined(t).gold("kpi_movimientos"),
    **{f"layer_{name}": _layer_table(name) for name in oracles.LAYER_TABLES},
    "facts_roundtrip": _facts_roundtrip,
    "snapshot_roundtrip": _snapshot_roundtrip,
    "etl_wide_files": _etl_wide_files,
    "tiles_csv_roundtrip": _tiles_csv_roundtrip,
    "kpi_sql": _kpi_sql,
    "kpi_sql_money": _kpi_sql_money,
    "dim_clientes": lambda t: silver.dim_clientes(t["cliente"], t["cliente_tel"]),
    "dim_beneficiarios": lambda t: silver.dim_beneficiarios(t["beneficiario"], t["beneficiario_tel"]),
    "dim_cuentas": lambda t: silver.dim_cuentas(t["cuenta"]),
    "dim_tarjetas": lambda t: silver.dim_tarjetas(t["tarjeta"]),
    "dim_tarjetas_masked": lambda t: silver.dim_tarjetas(t["tarjeta"], mask_cards=True),
    "fact_transacciones": lambda t: silver.fact_transacciones(t["transaccion"], t["cuenta"]),
    "fact_prestamos": lambda t: silver.fact_prestamos(t["prestamo"]),
    "pivot_model_credit": lambda t: silver.pivot_model_credit(t["transaccion"], t["cuenta"]),
    "kpi_capital": lambda t: gold.kpi_capital(t["cuenta"]),
    "kpi_movimientos": lambda t: gold.kpi_movimientos(t["transaccion"]),
    "kpi_prestamos": lambda t: gold.kpi_prestamos(t["prestamo"]),
    "rep_total_capital": lambda t: gold.report_total_capital(t["cuenta"]),
    "rep_avg_tx": lambda t: gold.report_average_transaction(t["transaccion"]),
    "rep_top_delegaciones": lambda t: gold.report_top_delegaciones(t["cliente"]),
    "rep_movement_mix": lambda t: gold.report_movement_mix(t["transaccion"]),
    "etl_wide": lambda t: extracts.wide_transactions(_silver(t)),
    "etl_wide_by_card": lambda t: extracts.wide_transactions(_silver(t), card_key="no_tarjeta"),
    "elt_wide": lambda t: extracts.full_transactions(_silver(t)),
    "elt_wide_by_card": lambda t: extracts.full_transactions(_silver(t), card_key="no_tarjeta"),
    "elt_tiles": _tiles_by("no_cuenta"),
    "elt_tiles_by_card": _tiles_by("no_tarjeta"),
    "elt_tiles_select": lambda t: extracts.tiled_transactions(_silver(t), method="select"),
    "elt_tiles_ranges": lambda t: extracts.tiled_transactions(_silver(t), method="ranges"),
    "dq_negative_balance": quality.negative_balance,
    "dq_nonpositive_amount": quality.nonpositive_amount,
    "dq_orphan_clients": quality.orphan_clients,
    "dq_beneficiary_pct": quality.beneficiary_total,
    "dq_checks": lambda t: quality.row_rule_failures(t, quality.domain_rules()),
    "dq_not_null": lambda t: quality.row_rule_failures(t, quality.not_null_rules()),
    "dq_lengths": lambda t: quality.row_rule_failures(t, quality.length_rules()),
    "dq_unique": quality.unique_failures,
    "dq_foreign_keys": quality.reference_failures,
    "dq_report": quality.quality_report,
    "dq_incremental": _dq_incremental,
    "dq_core": quality.core_report,
    "dq_summary": lambda t: quality.summary(quality.quality_report(t)),
    "dq_offending": lambda t: quality.offending_rows(t, quality.NEGATIVE_BALANCE),
    "my_accounts": _my_accounts,
    "tx_authorize_opening": _authorize("opening"),
    "tx_authorize_running": _authorize("running"),
    "tx_authorize_serial": _authorize("serial"),
    "tx_post_balances": lambda t: ledger.post_balances(t["cuenta"], t["transaccion_escalada"]),
    "tx_post_stream": _post_stream,
    "loan_authorize": lambda t: _loans(t).prestamo,
    "loan_balances": lambda t: _loans(t).cuenta,
    "loan_rejects": lambda t: _loans(t).rejected,
    "month_end_fee": lambda t: accounts.month_end_fee(t["cuenta"]),
    "register_clients": lambda t: _enrolled(t).cliente,
    "register_accounts": lambda t: _enrolled(t).cuenta,
    "register_rejects": lambda t: _enrolled(t).rejected,
    "delete_blockers": lambda t: deletion.delete_blockers(t, "cliente", t["cliente"]),
    "delete_cascade": _delete_cascade,
    "delete_set_null": _delete_set_null,
    "max_tx_date": lambda t: credit.latest_transaction(t["transaccion"]),
    "ml_features": _features,
    "ml_label": lambda t: credit.with_label(_features(t)).select("id_cliente", "label"),
    "credit_line_rule": _lines,
    "score_preview": _score_preview,
    "credit_score_check": _score_check,
    "ml_auc_exact": _auc_exact,
    "ml_metrics": lambda t: credit.train(_features(t)).metrics(),
    "credit_score": lambda t: credit.train(_features(t)).credit_lines(),
}


def _with_work_folder(query: Query) -> Query:
    """Intermediate tables go to the folder the cluster names; where it names none, to one of our own: a temporary one
    where all runs on one machine, else one in the warehouse, which the executors share."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if not spark.conf.get(CHECKPOINT_KEY, None) and not spark.sparkContext.getCheckpointDir():
            local = spark.sparkContext.master.split("[")[0] == "local"
            own = tempfile.mkdtemp(prefix="caudal-") if local else join_path(spark.conf.get("spark.sql.warehouse.dir"), "caudal-work")
            spark.sparkContext.setCheckpointDir(own)
        return query(spark, sf_dir)

    return run


try:  # the training-data operators can be left out
    import corpus_pipeline
    from caudal.llm.queries import ORACLES as LLM_ORACLES, QUERIES as LLM_QUERIES

    EXTRA_QUERIES = {**LLM_QUERIES, "pipeline": corpus_pipeline.run}
    EXTRA_ORACLES = {**LLM_ORACLES, **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})}
except ImportError:
    EXTRA_QUERIES, EXTRA_ORACLES = {}, {}


def queries() -> dict[str, Query]:
    own = {name: _on_tables(build) for name, build in QUERIES.items()}
    return {name: _with_work_folder(query) for name, query in {**own, **EXTRA_QUERIES}.items()}


def oracle_sql() -> dict[str, str]:
    return {**oracles.oracle_sql(), **EXTRA_ORACLES}
