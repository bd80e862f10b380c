from __future__ import annotations

from fractions import Fraction

import numpy as np
import pytest
from llm_fixtures import MIDDLE, entry  # noqa: F401

from caudal.llm import whitening as wh


def plain(rows):
    """``(n, {vec_id: deviation}, eigenvalues, vectors)`` from exact fractions and a dense solver."""
    ok = [(i, [int(np.floor(64 * float(c))) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    n = len(ok)
    x = np.array([v for _, v in ok], object)
    sums = x.sum(0)
    apart = x * n - sums
    cov = (apart.T @ apart) // 1
    v = np.array([[float(Fraction(int(c), n**3)) for c in line] for line in cov])
    values, vectors = np.linalg.eigh(v)
    return n, [(i, int((a * a).sum())) for (i, _), a in zip(ok, apart)], values[::-1], vectors[:, ::-1], apart


def test_query_equals_a_dense_solver(entry, spark):
    table = spark.read.parquet(f"{MIDDLE}/embeddings.parquet")
    n, deviations, values, vectors, apart = plain([(r.vec_id, r.embedding) for r in table.collect()])
    out = entry["op11_cholesky_whitening"](spark, MIDDLE)
    assert out.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = out.collect()
    assert len(got) == 32 * n and {r.n for r in got} == {n}
    assert sorted({(r.vec_id, r.deviation) for r in got}) == sorted(deviations)
    own = {(r.vec_id, r.component): r.whitened for r in got}
    white = np.array([[own[i, k] for k in range(1, 33)] for i, _ in deviations])
    want = (apart.astype(float) / n) @ vectors[:, :32] / np.sqrt(values[:32])
    signs = np.sign((white * want).sum(0))
    assert np.abs(white - want * signs).max() < 1e-8
    assert np.abs(np.cov(white.T, bias=True) - np.eye(32)).max() < 1e-10
    assert {r.identity_error for r in got}.pop() < 1e-10
    share = {r.component: r.explained for r in got}
    assert [share[k] for k in range(1, 33)] == pytest.approx(values[:32] / values.sum(), rel=1e-10)


def test_sums_do_not_depend_on_the_order(spark):
    table = spark.read.parquet(f"{MIDDLE}/embeddings.parquet")
    one = wh.fit(wh.usable(table), 64)
    other = wh.fit(wh.usable(table.orderBy("label").repartition(7)), 64)
    assert one.sums == other.sums and (one.values == other.values).all() and (one.axes == other.axes).all()


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 0.5]), (1, [1.0, 2.0, 0.5]), (2, None), (3, [1.0, None, 0.0]), (4, [nan, 0.0, 0.0]), (5, [inf, 0.0, 0.0]), (None, [-1.0, 2.0, 7.0]),
            (6, [0.0, 2.0, 1.0]), (7, []), (8, [3.0]), (9, [4.0, 2.0, 2.5])]
    names = ["component", "n", "v", "white", "at", "deviation", "i", "j", "dims"]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", *(f"'x' AS `{c}`" for c in names))
    got = wh.whiten(df).collect()
    n, deviations, values, _, _ = plain([r for r in rows if r[1] is None or len(r[1]) == 3])
    assert n == 5 and len(got) == 2 * n  # the second entry never varies
    assert sorted([r.deviation for r in got if r.component == 1]) == sorted(d for _, d in deviations)
    assert sum(r.vec_id is None for r in got) == 2
    assert {r.component: r.explained for r in got} == pytest.approx({1: values[0] / values.sum(), 2: values[1] / values.sum()})
    assert wh.whiten(df.limit(0)).collect() == [] == wh.whiten(df.where("vec_id = 1")).collect()
    assert wh.whiten(df.select("vec_id", df.embedding.cast("array<float>").alias("embedding"))).count() == 2 * n


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(10**9 * i), 1e12 + i, -float(i % 3)]) for i in range(200)] + [(900, [1e300, 0.0, 0.0])]
    df = spark.createDataFrame(rows[:200], "vec_id long, embedding array<double>")
    n, deviations, values, _, _ = plain(rows[:200])
    got = {r.vec_id: r for r in wh.whiten(df).collect()}
    assert {i: got[i].deviation if got[i].deviation is not None else int(got[i].deviation_text) for i in got} == dict(deviations)
    assert any(r.deviation is None for r in got.values())
    assert got[0].identity_error < 1e-4
    both = wh.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.n for r in both} == {201}


@pytest.mark.parametrize("dims,rank", [(1, 1), (2, 2), (7, 3), (20, 20), (33, 32)])
def test_factor_and_rotations(dims, rank):
    r = np.random.default_rng(dims)
    base = r.normal(size=(dims, rank)) * 10.0 ** -np.arange(rank).clip(0, 5)
    v = base @ base.T
    order, factor = wh.pivoted_cholesky(v)
    assert np.abs((factor @ factor.T) - v[np.ix_(order, order)]).max() < 1e-12 * np.abs(v).max()
    assert np.allclose(np.triu(factor[: factor.shape[1]], 1).astype(float), 0)
    values, axes = wh.principal_axes(v)
    k = min(rank, len(values))
    assert np.abs((axes.T @ axes)[:k, :k] - np.eye(k)).max() < 1e-12
    assert values[:k].astype(float) == pytest.approx(np.linalg.eigvalsh(v)[::-1][:k], rel=1e-3, abs=1e-14 * float(values[0]))


def test_quotients():
    for a, b in ((1, 3), (-(10**40), 7), (0, 5), (2**64 - 1, 1), (10**30 + 1, 10**30)):
        assert float(wh._quotient(a, b)) == pytest.approx(a / b, rel=1e-15)
