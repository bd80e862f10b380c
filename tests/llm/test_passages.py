from __future__ import annotations

from llm_fixtures import MIDDLE, documents, entry, middle_documents  # noqa: F401

from caudal.llm import line_dedup as ld

PASSAGE = " ".join(f"Word{i} and more words stand here, as number {i} of them." for i in range(8))


def out(df):
    return {r.doc_id: r for r in df.collect()}


def test_later_passages_go_and_offsets_are_of_the_original(documents):
    rows = [(1, f"Own start of one. {PASSAGE} Own end."), (2, f"Another beginning\n{PASSAGE}"), (3, f"Third, clean.\nIt has nothing of that."),
            (4, f"Begins mid line. {PASSAGE.upper()} And ends.")]
    found = out(ld.deduplicated(documents(rows, extra=True)))
    assert found[1].text == rows[0][1] and found[3].text == rows[2][1] and not found[1].spans
    assert found[2].text == "Another beginning\n" and found[4].text == "Begins mid line. And ends."
    for r in found.values():
        source = dict(rows)[r.doc_id]
        left, at = "", 0
        for s in r.spans:
            left, at = left + source[at : s.start], s.end
        assert left + source[at:] == r.text
        assert (r.n_chars, r.n_removed) == (len(r.text), len(source) - len(r.text))


def test_short_repeats_stay(documents):
    rows = [(i, f"And ornd. This one is number {i} of the lot.\nThe usual line.") for i in range(50)]
    assert all(r.n_removed == 0 for r in ld.deduplicated(documents(rows)).collect())


def test_nulls_repeats_and_ranks(documents):
    rows = [(5, PASSAGE), (5, PASSAGE), (3, PASSAGE + "\n" + PASSAGE), (None, PASSAGE), (6, None), (7, ""), (8, "\n\n"), (9, "x" * 100_000)]
    found = ld.deduplicated(documents(rows)).collect()
    by = [(r.doc_id, r.text) for r in found]
    assert by.count((3, PASSAGE + "\n")) == 1
    assert by.count((5, "")) == 2 and (None, "") in by
    assert (6, None) in by and (7, "") in by and (8, "\n\n") in by and (9, "x" * 100_000) in by
    kept = ld.drop_repeats(documents(rows, extra=True))
    assert sorted((str(r.doc_id), r.n_chars) for r in kept.collect() if r.text) == [("3", len(PASSAGE) + 1), ("8", 2), ("9", 100_000)]
    assert {r.doc_id for r in kept.collect()} == {3, 6, 7, 8, 9}
    assert ld.deduplicated(documents([])).collect() == []


def test_units_cover_a_text():
    for text in ("", "a", "a.\nb", "No end. Two! \t Three?\n\n  Four.Five", "\n", ". . .", "é.\r\nz"):
        spans = ld.units(text)
        covered = "".join(text[a:b] for a, b in spans)
        assert covered.replace("\n", "") == text.replace("\n", "")
        assert all(a < b for a, b in spans)


def plain_removed(rows):
    """Removed spans of every document by a loop over units in rank order."""
    seen, repeated = set(), {}
    for d, t in sorted(rows):
        for a, b in ld.units(t):
            key = ld.normalised(t[a:b])
            if key in seen:
                repeated.setdefault(d, set()).add(a)
            elif key:
                seen.add(key)
    return {d: ld._passages(t, repeated.get(d, set()), ld.PASSAGE) for d, t in rows}


def test_query_equals_a_loop(entry, spark, middle_documents):
    rows = [(r.doc_id, r.text) for r in middle_documents.select("doc_id", "text").collect()]
    want = plain_removed(rows)
    found = entry["op2_line_dedup"](spark, MIDDLE).collect()
    assert {r.doc_id: [(s.start, s.end) for s in r.spans] for r in found} == want
    assert any(want.values())


def test_texts_without_blanks(documents):
    han = "".join(chr(0x4E00 + 37 * i) for i in range(60))
    thai = "".join(chr(0x0E01 + i % 40) for i in range(70))
    inside = f"{han[:30]}。{han[30:]}！"
    rows = [(1, f"{han}\nOne."), (2, f"Two.\n{han}\nEnd."), (3, f"Three {thai}"), (4, f"Three {thai}"), (5, f"甲乙。{inside}丙"), (6, f"丁戊己？{inside}庚辛"), (7, "短い行。"), (8, "短い行。")]
    found = out(ld.deduplicated(documents(rows)))
    assert found[2].text == "Two.\n\nEnd." and found[4].text == "" and found[6].text == "丁戊己？庚辛"
    assert all(found[i].text == dict(rows)[i] for i in (1, 3, 5, 7, 8))
    assert {r.doc_id for r in ld.drop_repeats(documents(rows)).collect()} == {1, 2, 3, 5, 6, 7, 8}
