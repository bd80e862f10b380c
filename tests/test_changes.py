"""Changes between two states of a table, applied; and the exact AUC."""

import random

import pytest
from pyspark.sql import functions as F

from caudal.operators import changes, credit
from caudal.plans.lakehouse import Lake
from caudal.session import work_dir
from conftest import rows


def states(spark, seed, count=300):
    rng = random.Random(seed)
    value = lambda: rng.choice([None, "", "a", "b", "long " * 5])
    old = {i: (value(), value(), rng.choice([None, 1, 2])) for i in [None, *rng.sample(range(1000), count)]}
    new = {k: (v if rng.random() < 0.7 else (value(), value(), v[2])) for k, v in old.items() if rng.random() < 0.9}
    new |= {1000 + i: (value(), value(), i) for i in range(20)}
    frame = lambda state: spark.createDataFrame([(k, *v) for k, v in state.items()], "k long, a string, b string, n long").repartition(3)
    return old, new, frame(old), frame(new)


@pytest.mark.parametrize("seed", [1, 2])
def test_changes_equal_a_comparison_of_dictionaries(spark, seed):
    old, new, before, after = states(spark, seed)
    found = changes.compare(before, after.select("n", "b", "k", "a"), "k")
    want = [(k, "alta") for k in new if k not in old] + [(k, "baja") for k in old if k not in new]
    want += [(k, "cambio") for k in new if k in old and old[k] != new[k]]
    assert rows(found.keys) == sorted(want, key=repr)
    assert rows(changes.apply_changes(before, found, "k")) == rows(after)
    assert rows(found.rows) == sorted(((k, *new[k]) for k, what in want if what != "baja"), key=repr)


def test_equal_and_empty_states(spark):
    _, _, before, _ = states(spark, 3)
    assert changes.compare(before, before.orderBy("a").repartition(7), "k").keys.isEmpty()
    all_new = changes.compare(before.limit(0), before, "k")
    assert {r.operacion for r in all_new.keys.collect()} == {"alta"}
    assert rows(changes.apply_changes(before.limit(0), all_new, "k")) == rows(before)
    assert {r.operacion for r in changes.compare(before, before.limit(0), "k").keys.collect()} == {"baja"}


def test_null_and_empty_text_are_told_apart(spark):
    one = spark.createDataFrame([(1, None, "a")], "k long, a string, b string")
    for other in [(1, "a", None), (1, "", "a"), (1, None, "")]:
        assert changes.compare(one, spark.createDataFrame([other], one.schema), "k").keys.count() == 1


def test_sync_writes_what_changed_only(spark, sample):
    lake = Lake(spark, work_dir(spark))
    lake.ingest(lambda name: sample[name])
    later = sample["cuenta"].where("id_cliente % 3 <> 0")
    done = lake.sync(lambda name: later if name == "cuenta" else sample[name])
    assert list(done) == ["cuenta"] and rows(lake.bronze()["cuenta"]) == rows(later)
    assert lake.sync(lambda name: later if name == "cuenta" else sample[name]) == {}


def test_only_differing_buckets_are_joined_by_key(spark, sample):
    cuenta = sample["cuenta"]
    one = cuenta.withColumn("saldo", F.when(F.col("id_cliente") == 4, 0).otherwise(F.col("saldo")).cast("decimal(12,2)"))
    assert [r.operacion for r in changes.compare(cuenta, one, "no_cuenta").keys.collect()] == ["cambio"]


@pytest.mark.parametrize("seed", range(3))
def test_auc_counts_pairs(spark, seed):
    rng = random.Random(seed)
    data = [(rng.choice([None, 0.5, 0.5, -0.0, 0.0, rng.random(), 1e300]), rng.choice([0, 1, 1, None])) for _ in range(200)]
    got = credit.auc_by_ranks(spark.createDataFrame(data, "s double, y int").repartition(5), "s", "y").first()
    pos, neg = ([s for s, y in data if y == k and s is not None] for k in (1, 0))
    wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    assert (got.positivos, got.negativos) == (len(pos), len(neg)) and got.auc == pytest.approx(wins / (len(pos) * len(neg)), rel=1e-14)


def test_auc_without_both_labels(spark):
    one = spark.createDataFrame([(0.5, 1)], "s double, y int")
    assert tuple(credit.auc_by_ranks(one, "s", "y").first()) == (1, 0, None)
    assert tuple(credit.auc_by_ranks(one.limit(0), "s", "y").first()) == (0, 0, None)
