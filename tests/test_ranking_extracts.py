import random

import pytest
from pyspark.sql import functions as F

from caudal.operators import extracts
from caudal.operators.ranking import select_bounds, with_counted_ntile, with_ntile, with_row_number
from caudal.sources.files import ContractError, check_contract
from conftest import rows


def ntile(values, tiles):
    """The textbook tile of each value, as a sorted list of (value, tile)."""
    small, extra = divmod(len(values), tiles)
    out, at = [], 0
    for t in range(tiles):
        size = small + (t < extra)
        out += [(v, t + 1) for v in sorted(values, key=lambda v: (v is not None, v or 0))[at : at + size]]
        at += size
    return sorted(out, key=repr)


@pytest.mark.parametrize("count, tiles", [(0, 4), (1, 4), (3, 4), (4, 4), (103, 4), (103, 7), (50, 1)])
def test_ntile_sizes(spark, count, tiles):
    rng = random.Random(count)
    values = [rng.choice([None, *range(200)]) for _ in range(count)]
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(3)
    assert rows(with_ntile(df, tiles, ["v"], "t")) == ntile(values, tiles)


def test_ntile_when_one_key_holds_most_rows(spark):
    values = [5] * 300 + list(range(150))
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(5)
    assert rows(with_ntile(df, 4, ["v"], "t")) == ntile(values, 4)


def test_ntile_equals_the_window(silver):
    ours = extracts.tiled_transactions(silver)
    ranges = extracts.tiled_transactions(silver, method="ranges")
    assert ours.exceptAll(ranges).count() == ranges.exceptAll(ours).count() == 0
    window = extracts.tiled_transactions(silver, method="window")
    assert ours.exceptAll(window).count() == window.exceptAll(ours).count() == 0
    assert ours.columns == list(extracts.TILED_COLUMNS)


def test_ntile_refuses_nonsense(spark):
    with pytest.raises(ValueError):
        with_ntile(spark.range(1), 0, ["id"], "t")
    with pytest.raises(ValueError):
        with_ntile(spark.range(1), 2, ["id"], "t", method="guess")


def test_row_number_is_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(6)
    got = with_row_number(df, ["k"], "n").collect()
    assert sorted((r["k"], r["n"]) for r in got) == [(k, k + 1) for k in range(1000)]


def build(frame):
    tx = frame(
        [(1, "k1", "x", "a1", "5"), (2, "k9", "x", "a2", "6"), (3, "k3", "x", "a3", "7"), (4, "k1", "x", None, "8")],
        "id_transaccion long; no_tarjeta string; cuenta_destino string; cuenta_origen string; monto decimal(16,2)",
    ).withColumns(
        {"tipo_movimiento": F.lit("Retiro"), "fecha_transaccion": F.lit("2024-01-01").cast("timestamp_ntz")}
    )
    return {
        "transacciones": tx,
        "cuentas": frame(
            [("a1", "Ahorro", "10", 1), ("a2", "Nomina", "20", 99)],
            "no_cuenta string; tipo_cuenta string; saldo decimal(12,2); id_cliente long",
        ),
        # a3 has a card but no account row.
        "tarjetas": frame(
            [("k1", "a1", "Activa", "Visa"), ("k2", "a1", "Vencida", "Visa"), ("k3", "a3", "Activa", "Visa")],
            "no_tarjeta string; no_cuenta string; estado string; emisor string",
        ),
        # Client 99 has a loan but no client row.
        "clientes": frame([(1,)], "id_cliente long"),
        "prestamos": frame([(1, "Activo"), (1, "Pagado"), (99, "Activo")], "id_cliente long; estado string"),
        "beneficiarios": frame([("a1",), ("a1",), ("a1",), ("a3",)], "no_cuenta string"),
    }


def test_wide_rows_multiply_by_card(frame):
    got = rows(extracts.wide_transactions(build(frame)).select("id_transaccion", "id_cliente", "estado"))
    assert got == sorted([(1, 1, "Activa"), (1, 1, "Vencida"), (2, 99, None), (3, None, "Activa"), (4, None, None)], key=repr)


def test_wide_by_card_number(frame):
    got = rows(extracts.wide_transactions(build(frame), card_key="no_tarjeta").select("id_transaccion", "id_cliente", "estado"))
    assert got == sorted([(1, 1, "Activa"), (2, 99, None), (3, None, "Activa"), (4, None, "Activa")], key=repr)


def test_full_rows_multiply_by_card_beneficiary_and_loan(frame):
    full = extracts.full_transactions(build(frame))
    assert full.columns == list(extracts.FULL_COLUMNS)
    counts = {r["id_transaccion"]: r["count"] for r in full.groupBy("id_transaccion").count().collect()}
    assert counts == {1: 2 * 3 * 2, 2: 1, 3: 1, 4: 1}
    assert full.where("id_transaccion = 2").first()["estado_prestamo"] is None


def test_many_equal_matches_are_all_kept(frame):
    t = build(frame)
    t["beneficiarios"] = frame([("a1",)] * 25_001, "no_cuenta string")
    counts = {r["id_transaccion"]: r["count"] for r in extracts.full_transactions(t).groupBy("id_transaccion").count().collect()}
    assert counts == {1: 2 * 25_001 * 2, 2: 1, 3: 1, 4: 1}


def test_a_hot_account_unfolds_in_all_tasks(frame, spark):
    t = build(frame)
    t["transacciones"] = spark.range(200).select(
        F.col("id").alias("id_transaccion"), F.lit("k1").alias("no_tarjeta"), F.lit("x").alias("cuenta_destino"),
        F.lit("a1").alias("cuenta_origen"), F.lit(1).cast("decimal(16,2)").alias("monto"),
        F.lit("Retiro").alias("tipo_movimiento"), F.lit("2024-01-01").cast("timestamp_ntz").alias("fecha_transaccion"),
    )
    t["beneficiarios"] = spark.range(20_000).select(F.lit("a1").alias("no_cuenta"))
    full = extracts.full_transactions(t).groupBy(F.spark_partition_id().alias("task")).count()
    sizes = [r["count"] for r in full.collect()]
    assert sum(sizes) == 200 * 20_000 * 2 * 2
    assert len(sizes) == 4 and max(sizes) < sum(sizes) / 2


@pytest.mark.parametrize("method", ["select", "ranges"])
@pytest.mark.parametrize("tiles", [1, 3, 4, 7])
def test_counted_tiles_equal_the_unfolded_ones(spark, tiles, method):
    rng = random.Random(tiles)
    counts = [(rng.choice([None, *range(12)]), rng.choice([1, 2, 40])) for _ in range(60)] + [(5, 900)]
    df = spark.createDataFrame(counts, "v long, n long").repartition(5)
    tiled = with_counted_ntile(df, tiles, ["v"], "t", "n", method=method).collect()
    unfolded = sorted(((r["v"], r["t"]) for r in tiled for _ in range(r["n"])), key=repr)
    assert unfolded == ntile([v for v, n in counts for _ in range(n)], tiles)


@pytest.mark.parametrize("enough, buckets", [(1, 2), (1, 3), (5, 1000), (10_000, 4)])
@pytest.mark.parametrize("spread", [3, 10**6, 2**63])
def test_selection_narrows_to_the_exact_row(spark, enough, buckets, spread):
    """Bounds over a hot value, NULLs, negative and very far keys, and a text as last column, against a full sort."""
    rng = random.Random(spread % 997 + buckets)
    far = lambda: rng.choice([None, 7, 7, 7, rng.randrange(-spread, spread), -(2**63), 2**63 - 1])
    data = [(far(), rng.choice([None, -2, rng.randrange(spread)]), rng.choice([None, "a", "b"]), rng.choice([1, 3, 50]), i) for i in range(300)]
    df = spark.createDataFrame(data, "a long, b long, c string, n long, tie long").repartition(3)
    order = sorted(data, key=lambda r: tuple((v is not None, v if v is not None else 0 if i != 2 else "") for i, v in enumerate((r[0], r[1], r[2])))+(r[4],))
    total, tiles = sum(r[3] for r in data), 5
    small, extra = divmod(total, tiles)
    want = []
    for t in range(1, tiles):
        rank, before = small * t + min(t, extra), 0
        for r in order:
            if rank <= before + r[3]:
                want.append((t, (r[0], r[1], r[2], r[4]), rank - before))
                break
            before += r[3]
    got = select_bounds(df, ["a", "b", "c", "tie"], tiles, "n", enough, buckets).collect()
    assert sorted((r.tile, tuple(r.bound), r.cut) for r in got) == want


def test_counted_tiles_of_few_or_no_rows(spark):
    empty = spark.createDataFrame([], "v long, n long")
    assert with_counted_ntile(empty, 4, ["v"], "t", "n").count() == 0
    one = with_counted_ntile(spark.createDataFrame([(1, 3)], "v long, n long"), 4, ["v"], "t", "n")
    assert sorted((r["t"], r["n"]) for r in one.collect()) == [(1, 1), (2, 1), (3, 1)]


def test_files_fixes_the_number_of_partitions(silver):
    assert extracts.wide_transactions(silver, files=4).rdd.getNumPartitions() == 4


def test_unknown_card_key(silver):
    with pytest.raises(ValueError):
        extracts.wide_transactions(silver, card_key="cvv")


def test_tile_frames_split_the_whole(silver):
    tiled = extracts.tiled_transactions(silver)
    parts = extracts.tile_frames(tiled)
    sizes = [df.count() for df in parts.values()]
    assert list(parts) == ["bloque_1", "bloque_2", "bloque_3", "bloque_4"]
    assert sum(sizes) == tiled.count() and max(sizes) - min(sizes) <= 1


def test_contract(silver):
    wide = extracts.wide_transactions(silver)
    check_contract(wide, extracts.WIDE_COLUMNS)
    check_contract(wide, wide.schema)
    with pytest.raises(ContractError):
        check_contract(wide.drop("saldo"), extracts.WIDE_COLUMNS)
    with pytest.raises(ContractError):
        check_contract(wide.withColumn("saldo", F.col("saldo").cast("double")), wide.schema)
