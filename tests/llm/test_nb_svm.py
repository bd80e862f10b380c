from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from llm_fixtures import MIDDLE, documents, entry  # noqa: F401

from caudal.llm import nb_svm as nb
from caudal.llm.text import window_hashes

LABEL = "doc_id long, quality int, toxic int"


def out_of_fit(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_held_out_documents_are_told_apart(entry, spark):
    got = {r.doc_id: r for r in entry["op12_nb_svm"](spark, MIDDLE).collect()}
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet").collect() for t in ("documents", "labels"))
    assert len(got) == len(docs) and all(got[r.doc_id].held_out == out_of_fit(r.doc_id) for r in docs)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    held = [(r.quality, got[r.doc_id]) for r in labels if out_of_fit(r.doc_id) and r.quality is not None]
    assert len(held) > 50 and sum(q == r.predicted for q, r in held) >= 0.97 * len(held)
    low, high = [r.score for q, r in held if q == 0], [r.score for q, r in held if q == 1]
    assert np.mean([a < b for a in low for b in high]) > 0.99


def test_held_out_labels_teach_nothing(spark):
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality", "toxic")
    one, other = nb.fit(docs, labels), nb.fit(docs.repartition(5), turned)
    assert (one.ratios == other.ratios).all() and (one.weights == other.weights).all() and one.slope == other.slope


def test_counts_cover_all_labelled_documents(spark):
    """Ratios come from every labelled text, whatever the sample; a plain count gives the same."""
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    model = nb.fit(docs, labels, sample=40)
    texts, grams, counts = {r.doc_id: r.text for r in docs.collect()}, nb.Grams(), np.zeros((2, nb.BUCKETS))
    for r in labels.collect():
        if r.quality is not None and not out_of_fit(r.doc_id) and r.doc_id in texts:
            counts[r.quality, grams.of(texts[r.doc_id])] += 1
    p, q = (counts[1] + 1) / (counts[1] + 1).sum(), (counts[0] + 1) / (counts[0] + 1).sum()
    assert model.ratios == pytest.approx(np.where(counts.sum(0) > 0, np.log(p / q), 0))


def test_grams_of_a_text(monkeypatch):
    """Against a loop over all runs of words and shapes; the pieces a text is read in don't show."""
    r = random.Random(2)
    text = " ".join(r.choice(["The", "the", "SHOUT!!", "it", "a|b", "99", "x%%%", "É", "…", "'quoted'", "|"]) for _ in range(500))
    words = text.split()
    hashes = [tuple(map(int, nb._Words().of([w.encode()])[0])) for w in words]
    shapes = [s ^ (0x9E3779B97F4A7C15 if i and words[i].lower() == words[i - 1].lower() else 0) for i, (_, s) in enumerate(hashes)]
    want = set()
    for i in range(len(words)):
        for n in nb.WORD_RUNS:
            if i + n <= len(words):
                want.add(int(window_hashes(np.array([h for h, _ in hashes[i : i + n]], np.uint64), n)[0]) >> 46)
        for n in nb.SHAPE_RUNS:
            if i + n <= len(words):
                want.add((int(window_hashes(np.array(shapes[i : i + n], np.uint64), n)[0]) >> 48) + (1 << 18))
    grams = nb.Grams()
    whole = grams.of(text)
    assert whole.tolist() == sorted(want)
    pieces = nb.blank_pieces
    monkeypatch.setattr(nb, "blank_pieces", lambda raw: pieces(raw, 7))
    assert grams.of(text.replace(" ", "\t\n ")).tolist() == sorted(want)
    assert len(grams.of(None)) == len(grams.of(" \n")) == 0


def test_dual_descent_reaches_the_minimum():
    """The duality gap is small: no other weights can have a much smaller loss."""
    r = np.random.default_rng(3)
    rows = [np.sort(r.choice(50, 6, replace=False)) for _ in range(200)]
    values = [v / np.sqrt(v @ v) for v in r.normal(size=(200, 6))]
    signs = np.where(r.random(200) < 0.3, -1, 1)
    w = nb.dual_descent(rows, values, signs, 50, passes=500)
    margins = np.array([signs[i] * (w[rows[i]] @ values[i] + w[-1]) for i in range(200)])
    primal = w @ w / 2 + np.maximum(0, 1 - margins).sum()
    for _ in range(200):
        other = w + r.normal(size=51) * r.choice([0.3, 0.05, 0.005])
        m = np.array([signs[i] * (other[rows[i]] @ values[i] + other[-1]) for i in range(200)])
        assert other @ other / 2 + np.maximum(0, 1 - m).sum() > primal - 0.05


def test_probabilities_follow_the_margins():
    r = np.random.default_rng(5)
    margins = r.normal(size=5000) * 2
    signs = np.where(r.random(5000) < 1 / (1 + np.exp(-(1.5 * margins - 0.7))), 1, -1)
    assert nb.sigmoid_fit(margins, signs) == pytest.approx((1.5, -0.7), abs=0.15)
    a, b = nb.sigmoid_fit(np.array([-1.0, 1.0, 2.0]), np.array([-1, 1, 1]))
    assert a > 0 and np.isfinite([a, b]).all()
    assert nb.sigmoid_fit(np.array([1.0, 2.0, -1.0, -2.0]), np.array([-1, -1, 1, 1])) == (0.0, 0.0)


def test_edges(spark, documents):
    r = random.Random(1)
    good = lambda: " ".join(r.choice(["plain", "words", "make", "sense", "here"]) for _ in range(30)) + "."
    bad = lambda: " ".join(r.choice(["BUY!!", "NOW!!", "$$$"]) for _ in range(30))
    rows = [(i, bad() if i % 3 == 0 else good()) for i in range(90)]
    rows += [(100, None), (101, ""), (102, "plain " * 300_000), (103, "y" * 300_000), (None, good()), (0, rows[0][1]), (1, rows[1][1])]
    labels = [(i, int(i % 3 > 0), 0) for i in range(90)] + [(5, 0, 0), (5, 1, 0), (7, None, 1), (8, 2, 0), (None, 0, 0), (999, 1, 0)]
    table = spark.createDataFrame(labels, LABEL).selectExpr("*", "'x' AS label", "'y' AS id", "'z' AS text")
    got = nb.classify(documents(rows, extra=True), table).collect()
    assert sorted((r.doc_id for r in got), key=str) == sorted((i for i, _ in rows), key=str)
    assert all(r.predicted == int(r.doc_id % 3 > 0) for r in got if r.doc_id is not None and r.doc_id < 90)
    assert all(r.held_out == (r.doc_id is not None and out_of_fit(r.doc_id)) for r in got)
    blank = {r.doc_id: r.score for r in got if r.doc_id in (100, 101)}
    assert blank[100] == blank[101]
    assert nb.classify(documents([]), table).collect() == []
    for few in (table.limit(0), table.where("quality = 1")):
        scores = {r.score for r in nb.classify(documents(rows), few).collect()}
        assert len(scores) == 1 and 0.5 <= scores.pop() < 1
