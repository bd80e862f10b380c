from __future__ import annotations

import random

import numpy as np
import plain
import pytest
from llm_fixtures import MIDDLE, documents, entry, middle_documents  # noqa: F401

from caudal.llm import hyperminhash as hm
from caudal.llm.components import components
from caudal.llm.text import WordHashes, shingle_set, words


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


@pytest.mark.parametrize("percent", [80, 85])
def test_components_equal_all_pairs(spark, middle_documents, percent):
    rows = [(r.doc_id, r.text) for r in middle_documents.select("doc_id", "text").collect()]
    want, sizes = plain.components(rows, percent)
    found = got(hm.near_duplicates(middle_documents, percent))
    assert found == {d: (sizes[d], want[d], want[d] == d) for d, _ in rows}
    assert any(c != d for d, c in want.items())


def test_query_is_the_operator(entry, spark, middle_documents):
    assert got(entry["op4_hyperminhash"](spark, MIDDLE)) == got(hm.near_duplicates(middle_documents))


def test_a_large_tight_group_and_a_common_passage(documents):
    """300 near copies of one text, 60 different texts with a long common passage, and a chain."""
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(160)]
    rows = []
    for i in range(300):
        w = list(base)
        for _ in range(r.randrange(3)):
            w[r.randrange(len(w))] = word()
        rows.append((i, " ".join(w)))
    passage = [word() for _ in range(60)]
    rows += [(1000 + i, " ".join([*passage, *(word() for _ in range(25))])) for i in range(60)]
    chain = [word() for _ in range(120)]
    for i in range(12):
        rows.append((2000 + i, " ".join(chain)))
        chain = chain[2:] + [word(), word()]
    want, sizes = plain.components(rows, 85)
    assert got(hm.near_duplicates(documents(rows))) == {d: (sizes[d], want[d], want[d] == d) for d, _ in rows}
    assert len({want[2000 + i] for i in range(12)}) == 1


def test_nulls_ties_repeats_and_long_texts(documents):
    long = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One TWO"), (6, "one two three"), (7, long), (8, long + " end"),
            (9, "x" * 200_000), (10, "x" * 200_000), (None, "one two"), (None, None), (4, "one two"), (11, "É b c d e f"), (12, "é b c d e f")]
    out = hm.near_duplicates(documents(rows, extra=True)).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in out if r.doc_id is not None) == [
        (1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (4, 4, True), (5, 4, False), (6, 6, True), (7, 7, True), (8, 7, False),
        (9, 9, True), (10, 9, False), (11, 11, True), (12, 12, True)]
    assert [(r.component_id, r.kept) for r in out if r.doc_id is None] == [(None, True)] * 2
    assert {r.n_shingles for r in out if r.doc_id in (1, 2, 3)} == {0}
    assert hm.near_duplicates(documents([])).collect() == []


def test_dropping_keeps_columns_and_the_first(documents):
    text = "a b c d e f g h i j"
    left = hm.drop_near_duplicates(documents([(3, text), (2, text), (5, "other words"), (None, text), (6, None)], extra=True))
    assert sorted((r.doc_id for r in left.collect()), key=str) == [2, 5, 6, None]
    assert left.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]


def test_estimates_and_bands():
    r = np.random.default_rng(1)
    pool = np.unique(r.integers(0, 2**63, 4000).astype(np.uint64))
    for keep in (0.5, 0.8, 0.95):
        a, b = pool[: int(len(pool) * (1 + keep) / 2)], pool[int(len(pool) * (1 - keep) / 2) :]
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        sa, sb = hm.sketch(a)[None], hm.sketch(b)[None]
        j, used = hm.estimate(sa, sb, np.array([len(a)]), np.array([len(b)]))
        assert abs(j[0] - true) < 5 * np.sqrt(true * (1 - true) / used[0]) + 0.01
    tiny = shingle_set(WordHashes().of(words("a b c d e f g h i j k")))
    same = hm.band_keys(np.stack([hm.sketch(tiny), hm.sketch(tiny)]))
    assert (same[0] == same[1]).all() and len(set(same[0])) == hm.BANDS
    assert (hm.densify(hm.sketch(tiny)[None]) > 0).all()
    assert not hm.densify(np.zeros((1, hm.REGISTERS), np.uint16)).any()


def test_long_chains_become_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7), (None, 3)], "a long, b long")
    found = {r.id: r.component for r in components(links, "a", "b").collect()}
    assert found == {**{i: 0 for i in range(1, 201)}, 501: 500}
    assert components(links.where("a = 7 AND b = 7"), "a", "b").collect() == []


def test_candidates_grow_with_a_group_not_with_its_square(documents, monkeypatch):
    """Copies of a text of 300 words with three words changed: most pairs are just too far apart, all hang together."""
    counted = []
    likely = hm._Confirm.__call__

    def watched(self, pairs, sets=None):
        counted.append(pairs.count())
        return likely(self, pairs, sets)

    monkeypatch.setattr(hm._Confirm, "__call__", watched)
    made = {}
    for size in (500, 1000):
        r = random.Random(size)
        word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
        base = [word() for _ in range(300)]
        rows = []
        for i in range(size):
            w = list(base)
            for at in r.sample(range(300), 3):
                w[at] = word()
            rows.append((i, " ".join(w)))
        counted.clear()
        found = got(hm.near_duplicates(documents(rows)))
        made[size] = sum(counted)
        if size == 500:
            want, sizes = plain.components(rows, 85)
            assert found == {d: (sizes[d], want[d], want[d] == d) for d, _ in rows}
    assert made[1000] <= 2.2 * made[500]
