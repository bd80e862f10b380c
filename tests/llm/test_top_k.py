from __future__ import annotations

import numpy as np
import pytest
from llm_fixtures import MIDDLE, entry  # noqa: F401

from caudal.llm import bit_sliced as bs


def plain(rows, k=10, every=100):
    ok = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, qv in ok:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in ok if i != q and len(v) == len(qv))[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def test_query_equals_all_scores(entry, spark):
    table = spark.read.parquet(f"{MIDDLE}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    assert sorted(map(tuple, entry["op6_bit_sliced"](spark, MIDDLE).collect())) == plain(rows)


def test_edges(spark, monkeypatch):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -2.5, 0.001]), (1, [1.0, -2.5, 0.001]), (2, None), (3, [1.0, None, 0.0]), (4, [nan, 0.0, 0.0]), (5, [inf, 0.0, 0.0]), (None, [1.0, 1.0, 1.0]),
            (100, [0.0, 0.0, 0.0]), (200, [-900.0, 3.3, 70000.25]), (6, [1.0]), (300, []), (7, []), *((i, [1.0, -2.5, 0.001]) for i in range(400, 430))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS dims", "'y' AS segment", "'z' AS query_id", "1 AS seq")
    found = sorted(map(tuple, bs.top_k(df).collect()))
    assert found == plain(rows)
    assert sorted(map(tuple, bs.top_k(df.repartition(9), k=3).collect())) == plain(rows, 3)
    assert bs.top_k(df.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_sums_and_selection_by_bitmaps(seed):
    r = np.random.default_rng(seed)
    n, dims = int(r.integers(1, 300)), int(r.integers(1, 9))
    wide = 10 ** int(r.integers(0, 7))
    values = r.integers(-wide, wide + 1, (n, dims))
    query = r.integers(-wide, wide + 1, dims)
    total = bs.score_slices([bs.slices_of(values[:, d]) for d in range(dims)], query)
    bits = np.array([bs._rows_of(t, n).tolist().__contains__ for t in total], object)
    scores = [sum((-1 if i == len(total) - 1 else 1) * has(row) * (1 << i) for i, has in enumerate(bits)) for row in range(n)]
    assert scores == (values @ query).tolist()
    alive = np.packbits(np.r_[np.ones(n, np.uint8), np.zeros(-n % 64, np.uint8)], bitorder="little").view(np.uint64)
    sure, tied = bs.top_rows(total, alive, 5)
    order = sorted(scores, reverse=True)
    rows = set(bs._rows_of(sure, n)) | set(bs._rows_of(tied, n))
    assert len(bs._rows_of(sure, n)) <= 5 and (len(rows) >= min(5, n))
    assert {scores[i] for i in rows} == set(order[:5])


def test_signed_digits():
    for v in (*range(-70, 70), 10**12 + 7, -(2**40)):
        assert sum((-1 if neg else 1) << at for at, neg in bs.signed_digits(v)) == v
