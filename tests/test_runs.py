"""Whole runs: layers, extracts, scoring, streaming."""

import pytest
from pyspark.sql import functions as F

from caudal.operators.extracts import FULL_COLUMNS, WIDE_COLUMNS, full_transactions, wide_transactions
from caudal.operators.ledger import accepted, authorize, post_balances
from caudal.operators.silver import SILVER_TABLES
from caudal.plans import lakehouse, scoring
from caudal.plans.extracts import extract_tiles, extract_wide
from caudal.schemas import TABLES
from caudal.session import work_dir
from caudal.sources.files import read_csv
from caudal.streaming.posting import LedgerState, stream_postings
from conftest import rows


@pytest.fixture(scope="module")
def lake(spark, sample):
    return lakehouse.run(spark, work_dir(spark), lambda name: sample[name], partition_fact=True)


def test_layers(lake, sample):
    assert {r["tabla"]: r["filas"] for r in lake.bronze_counts().collect()} == {n: sample[n].count() for n in TABLES}
    silver = lake.silver()
    assert set(silver) == set(SILVER_TABLES)
    assert silver["dim_fact_transacciones"].count() == sample["transaccion"].count()
    assert lake.gold("kpi_movimientos").agg(F.sum("movimientos")).first()[0] == sample["transaccion"].count()
    assert lake.gold("kpi_capital").count() == 1 and lake.gold("kpi_prestamos").count() > 0


def test_month_partitions_are_pruned(lake):
    one = lake.silver()["dim_fact_transacciones"].where("periodo = '1996-03'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(periodo" in plan and one.count() > 0


def test_run_can_be_repeated(lake, sample):
    before = rows(lake.gold("kpi_prestamos"))
    lake.ingest(lambda name: sample[name])
    lake.refine(partition_fact=True)
    lake.publish()
    assert rows(lake.gold("kpi_prestamos")) == before


def test_wide_extract(spark, lake, silver):
    path = extract_wide(lake, files=4)
    wide = wide_transactions(silver)
    back = read_csv(spark, path, wide.schema)
    assert back.columns == list(WIDE_COLUMNS)
    assert rows(back) == rows(wide)
    assert len(spark.read.text(path).inputFiles()) == 4


def test_tiled_extract(spark, lake, silver):
    path = extract_tiles(lake)
    full = full_transactions(silver)
    back = read_csv(spark, path, full.schema.add("bloque", "integer"))
    assert rows(back.select(*FULL_COLUMNS)) == rows(full)
    sizes = [r["count"] for r in back.groupBy("bloque").count().collect()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 1


def test_scoring(lake):
    model = scoring.score(lake)
    first, total = scoring.read_scores(lake)
    assert first.count() == 20 and total == model.scored.count()


@pytest.fixture
def arrivals(spark, sample):
    folder = work_dir(spark)
    tx = sample["transaccion_escalada"]
    top = tx.agg(F.max("id_transaccion")).first()[0] + 1

    def deliver(start, end):
        part = tx.where((F.col("id_transaccion") >= int(start * top)) & (F.col("id_transaccion") < int(end * top)))
        part.coalesce(1).write.mode("append").parquet(folder)

    return folder, deliver


def test_stream_equals_the_batch(spark, sample, arrivals):
    folder, deliver = arrivals
    state = LedgerState(spark, work_dir(spark), compact_every=2)
    state.open(sample["cuenta"])
    for i in range(2):
        deliver(i / 3, (i + 1) / 3)
    stream_postings(spark, folder, state, files_per_batch=1).awaitTermination()
    deliver(2 / 3, 1)  # arrives later; the restarted query takes only this
    stream_postings(spark, folder, state, files_per_batch=1).awaitTermination()
    batch = authorize(sample["transaccion_escalada"], sample["cuenta"], "serial")
    seen = state.decisions()
    count = seen.count()
    assert sorted(r[0] for r in seen.select("batch").distinct().collect()) == [0, 1, 2]
    assert rows(seen.select(*batch.columns)) == rows(batch)
    expected = rows(post_balances(sample["cuenta"], accepted(batch)))
    assert rows(state.balances_after(2)) == expected
    # A retried batch overwrites what its first try left.
    again = sample["transaccion_escalada"].join(seen.where("batch = 2").select("id_transaccion"), "id_transaccion", "left_semi")
    state.apply(again.select(*TABLES["transaccion"].schema.fieldNames()), 2, "serial")
    assert rows(state.balances_after(2)) == expected and state.decisions().count() == count
