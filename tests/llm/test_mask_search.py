from __future__ import annotations

import math
import random
import re
from collections import Counter

import duckdb
import pytest
from llm_fixtures import MIDDLE, documents, entry  # noqa: F401

from caudal.llm import mask_search as ms

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def cut(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k=10):
    held = [(i, Counter(t), len(t)) for i, t in ((i, cut(text)) for i, text in docs) if t]
    n, total = len(held), sum(size for _, _, size in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(cut(text))
    out = []
    for item, own in asked.items():
        scored = []
        for i, c, size in held:
            m = 100 - 90 + (90 * size * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_equals_brute_force_and_its_sql(entry, spark):
    docs, items = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "benchmark"))
    want = plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    found = got(entry["op13_mask_search"](spark, MIDDLE))
    assert found == want and len(found) > 300
    import __spark_entry__ as e

    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{MIDDLE}/{t}.parquet'")
    assert sorted(db.execute(e.oracle_sql()["op13_mask_search"]).fetchall(), key=str) == want


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "'x' AS doc_id", "'y' AS score", "'z' AS rank")


def test_edges(documents, items):
    long = "Straße " + "alpha-beta_" * 5000 + "gamma"
    docs = [(1, None), (2, ""), (3, " .,-\x00\x7f"), (4, "Alpha beta"), (5, "alpha BETA"), (5, "alpha"), (None, "alpha beta"), (None, "beta"), (6, long),
            (7, "É é ÉÉ"), (8, "x" * 100_000), (9, "中文 straße Straße"), (-3, "beta alpha"), (10, "a\x00b a\x00b 7z")]
    asked = [(1, "ALPHA, beta!"), (2, None), (3, "..."), (4, "é"), (5, "x" * 100_000), (6, "STRAßE 中文"), (7, "nowhere"), (8, "alpha"), (8, "gamma a b 7Z"), (None, "beta")]
    found = got(ms.search(documents(docs, extra=True), items(asked)))
    assert found == plain(docs, asked) and {r[0] for r in found} == {1, 4, 5, 6, 8, None}
    assert got(ms.search(documents(docs), items(asked), block_bytes=1)) == found
    assert got(ms.search(documents(docs).repartition(5), items(asked), k=2)) == plain(docs, asked, 2)
    assert got(ms.search(documents([]), items(asked))) == [] == got(ms.search(documents(docs), items([])))


@pytest.mark.parametrize("seed", [0, 1])
def test_many_segments_long_items_and_small_masks(documents, items, monkeypatch, seed):
    """Words of very different rarity, items of 1 to 150 terms, segments of a few documents."""
    r = random.Random(seed)
    word = lambda: f"w{int(r.paretovariate(0.5)) % 400}"
    docs = [(i, " ".join(word() for _ in range(r.randrange(80)))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(40)]
    asked = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate((1, 2, 3, 8, 40, 150, 400))]
    want = plain(docs, asked)
    assert got(ms.search(documents(docs), items(asked))) == want
    rows = list(ms._segments({}) (iter([])))
    assert rows == []
    known = {}
    terms = [(i, [known.setdefault(t.encode(), len(known)) for t in dict.fromkeys(cut(text))]) for i, text in asked]
    monkeypatch.setattr(ms, "EVALUATED", 1)
    monkeypatch.setattr(ms, "MASK_BITS", 3000)
    held = ms._Segment(known)
    for i, text in docs:
        held.add(i, text)
    n, total = len(held.ids), sum(held.lengths)
    index = ms._Index(held.packed(), n, total)
    import numpy as np

    weights = np.array([ms.weight(n, d) for d in np.diff(index.bounds)])
    found = [(i, rank, int(index.ids[row]), s) for i, own in terms for rank, (row, s) in enumerate(index.best(own, weights[own], 10), 1)]
    assert sorted(found, key=str) == want


def test_long_counts_and_lengths():
    import numpy as np

    assert ms.length_penalty(np.array([10**12]), 10**9, 10**13)[0] == 10 + 90 * 10**12 * 10**9 // 10**13
    held = ms._Segment({b"a": 0})
    held.add(1, "a " * 70_000)
    index = ms._Index(held.packed(), 1, 70_000)
    assert index.worth.tolist() == [(10**9 * 70_000) // (1000 * 70_000 + 800)]
