from __future__ import annotations

import zlib

import numpy as np
from llm_fixtures import MIDDLE, documents, entry, middle_documents  # noqa: F401

from caudal.llm import language_id as li


def test_held_out_accuracy(entry, spark, middle_documents):
    langs = {r.doc_id: r.lang for r in middle_documents.select("doc_id", "lang").collect()}
    rows = entry["op8_rank_profiles"](spark, MIDDLE).collect()
    assert len(rows) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_predictions_use_the_text_alone(spark, middle_documents):
    a = {r.doc_id: r.lang_pred for r in li.identify(middle_documents).collect()}
    held = li.is_held_out()
    changed = middle_documents.selectExpr("doc_id", "text", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 = 0 THEN 'xx' ELSE lang END AS lang", "'s' AS source")
    b = {r.doc_id: r.lang_pred for r in li.identify(changed).collect()}
    assert a == b and middle_documents.where(held).count() > 100


def test_edges(documents):
    rows = [(i, "the cat and the dog " * 5, "en") for i in range(40)] + [(100 + i, "el perro y la casa ñ " * 5, "es") for i in range(40)]
    rows += [(200, None, "en"), (201, "", None), (202, "12 34 !!", "es"), (None, "the cat and the dog", "en"), (203, "a", None), (204, "the dog " * 50_000, None), (1, "the cat", "en")]
    out = li.identify(documents(rows, extra=True)).collect()
    said = [(r.doc_id, r.lang_pred, r.held_out) for r in out]
    assert len(out) == len(rows)
    assert {p for d, p, _ in said if d in (200, 201, 202)} == {"und"}
    assert (None, "en", False) in said and {p for d, p, _ in said if d == 204} == {"en"}
    assert [r.score for r in out if r.lang_pred == "und"] == [0.0] * 3
    assert li.identify(documents([])).collect() == []
    assert {r.lang_pred for r in li.identify(documents([(1, "no labels", None)])).collect()} == {"und"}


def test_profile_order_and_distance():
    g, n = li.ngrams("aab")
    assert n.sum() == 3 + 4 + 3  # letters, pairs with the word's ends, triples
    assert list(li.ranked(np.array([5, 3, 9]), np.array([2, 2, 7]), 2)) == [9, 3]
    p = li.Profiles.of({"x": np.array([1, 2, 3]), "y": np.array([3, 2, 1])}, 3)
    assert p.languages == ["x", "y"] and p.ranks.tolist() == [[0, 2], [1, 1], [2, 0]]


def test_stage_keeps_columns_and_text(documents):
    rows = [(i, "the cat and the dog sat on the mat " * 3, "en", "s") for i in range(30)] + [(99, "!!! 123", "en", "s"), (98, None, None, "s")]
    kept = li.keep_known(documents(rows, extra=True))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(30))
    assert kept.columns == documents(rows, extra=True).columns


def test_ngrams_do_not_depend_on_the_piece(monkeypatch):
    texts = ["", " . ", "a", "Ab  c.d é", "日本 x" * 3, " lead and trail ", "ab" * 9]
    whole = [li.ngrams(t) for t in texts]
    for piece in (1, 2, 3, 5):
        monkeypatch.setattr(li, "PIECE", piece)
        for text, (gram, n) in zip(texts, whole):
            got = li.ngrams(text)
            assert got[0].tolist() == gram.tolist() and got[1].tolist() == n.tolist()
