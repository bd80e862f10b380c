from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import plain
import pytest
from llm_fixtures import MIDDLE, documents, entry, middle_documents  # noqa: F401

from caudal.llm import mixing as mx


def check(rows, out, near=0.05):
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len(plain.WORDS.findall(text or ""))
    want = plain.targets(sizes)
    taken, by_size = Counter(), {}
    source_of = {d: s for d, _, _, s in rows}
    for r in out:
        s = source_of[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s], rel=1e-9)
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(mx.BLOCK, near * want[s]), (s, taken[s], want[s])
    return by_size


def test_targets_and_reruns(entry, spark, middle_documents):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in middle_documents.collect()]
    out = entry["op10_block_mixing"](spark, MIDDLE).collect()
    assert sorted(r.doc_id for r in out) == sorted(r[0] for r in rows)
    check(rows, out, near=0.01)
    assert sorted(out) == sorted(mx.mixed_counts(middle_documents.repartition(7)).collect())


def test_edges(documents):
    rows = [(1, None, None, "a"), (2, "", None, "a"), (3, "w " * 5000, None, "a"), (4, "x y z " * 2000, None, None), (5, "one", None, "é"), (6, "t " * 3000, None, "z"), (7, "t " * 300, None, "Z")]
    out = mx.mixed_counts(documents(rows, extra=True)).collect()
    check(rows, out)
    assert {r.doc_id: r.size for r in out} == {1: 0, 2: 0, 3: 5000, 4: 6000, 5: 1, 6: 3000, 7: 300}
    twice = mx.mixed_counts(documents([(1, "a b c", None, "s"), (1, "a b c", None, "s"), (None, "d e", None, "s")])).collect()
    assert len(twice) == 3 and sum(r.taken for r in twice) == 12  # 150 % capped by nothing: 8 of 8 words, one and a half times
    assert mx.mixed_counts(documents([])).collect() == []
    assert [r.taken for r in mx.mixed_counts(documents([(1, None, None, None)])).collect()] == [0]


def test_permutation_is_one():
    for n in (1, 2, 3, 7, 64, 1000):
        a, b = (mx.permuted(np.arange(n), n, k) for k in (1, 2))
        assert sorted(a) == sorted(b) == list(range(n))
    assert list(mx.permuted(np.arange(1000), 1000, 1)) != list(mx.permuted(np.arange(1000), 1000, 2))


def test_slots_are_dealt_in_proportion(documents):
    rows = [(i, "w " * 4000, None, f"s{i % 3}") for i in range(30)]
    sizes = mx._sized(documents(rows))
    dealt = mx.slots(mx.source_targets(sizes), shard_slots=200).groupBy("shard", "sid").count().collect()
    shards = defaultdict(dict)
    for r in dealt:
        shards[r.shard][r.sid] = r["count"]
    assert len(shards) > 5 and all(set(s) == {1, 2, 3} for s in shards.values())


def test_mixed_documents_are_what_was_counted(documents, middle_documents):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in middle_documents.limit(150).collect()] + [(9001, None, "en", "src1"), (9002, " ", "en", None)]
    docs = documents(rows, extra=True)
    mixed = mx.mix_documents(docs)
    assert mixed.columns == docs.columns
    counts = {r.doc_id: r.taken for r in mx.mixed_counts(docs).collect()}
    got, texts = Counter(), dict((r[0], r[1]) for r in rows)
    for r in mixed.collect():
        assert r.n_chars == (None if r.text is None else len(r.text))
        words = plain.WORDS.findall(r.text or "")
        got[r.doc_id] += len(words)
        own = Counter(plain.WORDS.findall(texts[r.doc_id] or ""))
        assert not Counter(words) - own
    assert {d: got[d] for d in counts if counts[d]} == {d: n for d, n in counts.items() if n} or abs(sum(got.values()) - sum(counts.values())) <= mx.BLOCK * 21
    assert {9001, 9002} <= {r.doc_id for r in mixed.select("doc_id").collect()}
