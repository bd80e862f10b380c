from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from llm_fixtures import MIDDLE, documents, entry, middle_documents  # noqa: F401
from tokenizers import Tokenizer

from caudal.llm import packing as pk


def check(rows, pieces, most_padding=0.01):
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = defaultdict(list)
    for doc_id, text in rows:
        ids[doc_id].append(np.array([*exact.encode(text or "", add_special_tokens=False).ids, 0], "<u4"))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
        options = [x for x in ids[p.doc_id] if len(x) == p.doc_tokens]
        assert any(zlib.crc32(x[p.start : p.start + p.length].tobytes()) == p.ids_crc32 for x in options)
    assert set(by_doc) == set(ids)
    for doc_id, own in by_doc.items():
        if len(ids[doc_id]) == 1:
            at = 0
            for p in sorted(own, key=lambda p: p.start):
                assert p.start == at and p.length > 0
                at += p.length
            assert at == len(ids[doc_id][0])
    padding = total = 0
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
        total += at
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert total == sum(len(x) for xs in ids.values() for x in xs)
    assert padding <= most_padding * total
    return by_sequence


def test_query_packs_every_id_once(entry, spark, middle_documents):
    rows = [(r.doc_id, r.text) for r in middle_documents.select("doc_id", "text").collect()]
    sequences = check(rows, entry["op5_tier_packing"](spark, MIDDLE).collect())
    whole = sum(len(own) == 1 and own[0].length == 1024 for own in sequences.values())
    assert whole > 0.3 * len(sequences)


def test_edges(documents):
    rows = [(1, None), (2, ""), (3, "a"), (4, "word " * 40_000), (5, "<|endoftext|> x"), (6, "é \U0001f600 \u0000\t\n"), (None, "none"), (3, "twin text"), (7, "x" * 30_000)]
    df = documents(rows, extra=True)
    check(rows, pk.pack(df.coalesce(1)).collect())
    assert pk.pack(documents([])).collect() == []
    again = lambda: sorted(map(tuple, pk.pack(df.coalesce(1)).collect()), key=str)
    assert again() == again()


def test_steps_are_balanced_and_ids_come_along(middle_documents):
    pieces = pk.pack(middle_documents.coalesce(2), with_ids=True).collect()
    steps, tiers = defaultdict(int), defaultdict(set)
    for p in pieces:
        assert len(p.ids) == p.length and zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32
        steps[p.step_id] += p.length
        tiers[p.step_id].add(p.tier)
    full = [s for s, n in steps.items() if n == pk.STEP]
    assert max(steps.values()) == pk.STEP and len(full) >= len(steps) - 2 * (len(pk.TIERS) + 1)
    assert all(len(tiers[s]) == 1 for s in full)
    assert {t for s in full for t in tiers[s]} >= {512, 1024}


def test_short_documents_fill_short_windows(documents):
    pieces = pk.pack(documents([(i, f"short text {i} " * (1 + i % 9)) for i in range(2000)]).coalesce(1)).collect()
    assert {p.tier for p in pieces} >= {128} and max(p.tier for p in pieces) == 128


def test_packer_fills_windows_from_shorter_tiers():
    out = []
    p = pk.Packer(lambda tier, parts: out.append((tier, parts)))
    for n, length in enumerate([700, 300, 130, 90, 60, 40, 1000, 5]):
        p.add(n, 0, length)
    p.finish()
    assert sum(x[2] for _, parts in out for x in parts) == 2325
    assert all(sum(x[2] for x in parts) == tier and tier & (tier - 1) == 0 for tier, parts in out)
    assert out[0][1][0] == (6, 0, 1000)
