from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import plain
from llm_fixtures import MIDDLE, documents, entry, middle_documents  # noqa: F401

from caudal.llm import perplexity as px
from caudal.llm.text import WordHashes


def test_base_figures_equal_a_loop(entry, spark, middle_documents):
    texts = {r.doc_id: r.text for r in middle_documents.select("doc_id", "text").collect()}
    for r in entry["op9_ngram_perplexity"](spark, MIDDLE).collect():
        want = plain.base_figures(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert r.base_failed == failed and not (failed and r.kept)
        assert failed or r.kept == (r.band_low <= r.log_ppl <= r.band_high)


def test_odd_white_space():
    for text in (None, "", "a b c", "x\x0by\x0cz\r\n\n \nq", "a b c d e f g h a b c d e f g h", "a " * 30, "#*|\n#*|\n#*|", "é \U0001f600"):
        assert px.base_figures(text, WordHashes()) == plain.base_figures(text)


def plain_model(texts):
    """Modified Kneser-Ney log probabilities of 4-grams by dictionaries."""
    raw = Counter(int(g) for t in texts for g in px.grams(t))
    tables = [raw]
    for order in (3, 2, 1):
        tables.append(Counter({}) if not tables[-1] else Counter(g & ((1 << 6 * order) - 1) for g in tables[-1]))
    tables = tables[::-1]

    def prob(g, order):
        if order == 0:
            return 1 / 64
        t = tables[order - 1]
        d = px._discounts(np.array(list(t.values())))
        own = {k: c for k, c in t.items() if k >> 6 == g >> 6}
        lower = prob(g & ((1 << 6 * (order - 1)) - 1), order - 1)
        if not own:
            return lower
        total = sum(own.values())
        gamma = sum(d[min(c, 3) - 1] for c in own.values()) / total
        c = own.get(g, 0)
        return (c - d[min(c, 3) - 1]) / total + gamma * lower if c else gamma * lower

    return raw, prob


def test_model_equals_dictionaries_and_sums_to_one():
    texts = ["the cat sat on the mat", "a cat and a hat. the end!", "on and on it goes, the cat"]
    raw, prob = plain_model(texts)
    model = px.Model(np.array(sorted(raw), np.uint32), np.array([raw[k] for k in sorted(raw)]))
    for g in [*raw, *(int(x) for x in px.grams("zebra quickly the cats"))]:
        assert np.isclose(model._log(np.array([g], np.uint32), 4)[0], np.log(prob(g, 4)), atol=1e-4)
    for context in ("the", " ca", "zzz"):
        last = int(px.grams(context)[-1]) & 0x3FFFF
        p = np.exp(model._log(np.array([(last << 6) | s for s in range(64)], np.uint32), 4))
        assert np.isclose(p.sum(), 1, atol=1e-3)


def test_counts_cover_the_corpus(spark, middle_documents):
    models = px.fit(middle_documents)
    want = defaultdict(set)
    for r in middle_documents.select("lang", "text").collect():
        want[r.lang or "und"].update(px.grams(r.text).tolist())
    assert {k: set(m.levels[-1].keys.tolist()) for k, m in models.items()} == dict(want)


def test_junk_is_rejected_and_clean_text_kept(documents):
    r = np.random.default_rng(3)
    vocabulary = ["the", "cat", "sat", "on", "mat", "dog", "ran", "home", "and", "slept"]
    rows = [(i, " ".join(r.choice(vocabulary, 60)), "en") for i in range(200)]
    junk = " ".join("".join(chr(int(c)) for c in r.integers(97, 123, 7)) for _ in range(60))
    rows += [(900, junk, "en"), (901, None, "en"), (902, "", None), (None, " ".join(r.choice(vocabulary, 60)), "en"), (903, "word " * 40, "en"), (3, rows[3][1], "en")]
    out = px.judge(documents(rows, extra=True)).collect()
    assert len(out) == len(rows)
    by = defaultdict(list)
    for x in out:
        by[x.doc_id].append((x.base_failed, x.kept))
    assert by[900] == [(False, False)] and by[901] == by[902] == by[903] == [(True, False)]
    assert by[None] == [(False, True)] and by[3] == [(False, True)] * 2
    assert all(by[i] == [(False, True)] for i in range(200) if i != 3)
    assert px.judge(documents([])).collect() == []


def prose(r, n, words, step):
    at, out = int(r.integers(len(words))), []
    for _ in range(n):
        out.append(words[at])
        at = (at * step + int(r.integers(4))) % len(words)
    return " ".join(out)


def test_word_salad_is_rejected_and_prose_kept(documents):
    r = np.random.default_rng(5)
    # All begin and end alike, so that characters do not tell in what order they stand.
    words = [f"tut{a}{b}utut" for a in "aeiou" for b in "aeiou"]
    han = [chr(0x4E00 + 40 * i) for i in range(25)]
    rows = [(i, prose(r, 80, words, 2), "en") for i in range(300)] + [(1000 + i, " ".join(prose(r, 80, han, 2).split()), "zh") for i in range(300)]
    salad = [(900 + i, " ".join(r.permutation(prose(r, 80, words, 2).split())), "en") for i in range(3)]
    salad += [(1900 + i, " ".join(r.permutation(prose(r, 80, han, 2).split())), "zh") for i in range(3)]
    kept = {x.doc_id: x.kept for x in px.judge(documents(rows + salad)).collect()}
    assert not any(kept[i] for i, *_ in salad) and all(kept[i] for i, *_ in rows)


def test_pairs_equal_a_loop(documents):
    texts = {
        1: ("The cat sat. The cat ran", "en"), 2: ("the dog sat, the dog sat", "en"), 3: ("the cat", "fr"), 4: ("\u6f22\u5b57 \u6f22\u5b57\u3002", "en"),
        5: ("The cat sat. The cat ran", "en"), 6: ("a zebra ran. A cat sat on the dog", "en"), 7: ("", "en"), 8: (None, None),
    }
    table = documents([(k, *v) for k, v in texts.items()]).coalesce(1)
    models = px.fit(table)
    found = {x.doc_id: x.log_ppl for x in px.score_words(table, models).collect()}
    assert found[7] is None and found[8] is None
    cut = {k: plain.tokens(t) for k, (t, _) in texts.items() if t}
    for lang in ("en", "fr"):
        own = [k for k in cut if texts[k][1] == lang]
        words = Counter(w for k in own for w in cut[k] if w != "<cap>")
        known = {w for w, n in words.items() if n >= 2}
        assert len(known) == len(models[lang].words)
        rows = {k: ["<s>", *(w if w in known or w == "<cap>" else "<unk>" for w in cut[k]), "</s>"] for k in own}
        every = Counter(p for t in {texts[k][0]: k for k in own}.values() for p in zip(rows[t], rows[t][1:]))
        want = plain.kneser_ney(every, len(known) + 3, px._discounts)
        for k in own:
            unknown = [w for w in px.TOKEN.findall(texts[k][0]) if w.lower() not in known]
            spelled = models[lang].logs(px.grams(" ".join(unknown))).sum() if unknown else 0.0
            assert np.isclose(found[k], -(sum(want(rows[k])) + spelled) / (len(rows[k]) - 1)), (k, lang)


def test_shuffled_documents_of_the_table_are_rejected(spark, documents):
    r = np.random.default_rng(11)
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("lang = 'en'").select("doc_id", "text", "lang", "source")
    whole = [x.text for x in rows.where("doc_id % 32 = 0").collect() if x.text and len(x.text.split()) >= 60]
    shuffled = documents([(-1 - i, " ".join(r.permutation(t.split())), "en") for i, t in enumerate(whole)])
    out = px.judge(rows.withColumn("n_chars", rows.doc_id * 0).unionByName(shuffled)).where("NOT base_failed").select("doc_id", "kept").collect()
    salad, prose = ([x.kept for x in out if (x.doc_id < 0) == wanted] for wanted in (True, False))
    assert len(salad) > 150 and np.mean(salad) <= 0.15 and np.mean(prose) >= 0.98


def test_tables_and_hashes_equal_the_expression():
    r = np.random.default_rng(2)
    odd = "Ab İstanbul ΟΔΟΣ Σ ΣΑΣ x́ 　漢字。 กข a_b 12½ ﬁ \U0001f600 \U0002000b ǅ   \x1c\x85 ß ẞ"
    texts = [odd, "", "word", "".join(chr(int(c)) for c in r.integers(0, 0xD800, 60_000)), "é" * 700_000 + " tail É" * 3, "Aa aA " * 100_000]
    hashes = {}
    for text in texts:
        starts, ends, found = px.token_runs(px._codes(text))
        parts = [text[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        assert parts == px.TOKEN.findall(text)
        for part, h in zip(parts, found.tolist()):
            assert hashes.setdefault(part.lower(), h) == h
        assert [bool(px._tables()[2][ord(p[0])]) for p in parts] == [p[0].isupper() for p in parts]
    assert len(set(hashes.values())) == len(hashes)
    assert not any(chr(c).lower() != chr(c) for c in range(px._CASED, 0x110000))


def test_tokens_are_numbered_without_a_loop():
    class Numbered:
        words = np.sort(px.token_runs(px._codes("the cat sat"))[2])
        numbers = np.arange(3) + px.FIRST
        logs = staticmethod(lambda g: -np.ones(len(g)))

    of = dict(zip(Numbered.words.tolist(), Numbered.numbers.tolist()))
    the, cat, sat = (of[int(px.token_runs(px._codes(w))[2][0])] for w in ("the", "cat", "sat"))
    ids, spelled = px.encoded("The cat SAT, Zebra", Numbered)
    assert ids.tolist() == [px.BEGIN, px.CAPITAL, the, cat, px.CAPITAL, sat, px.UNKNOWN, px.CAPITAL, px.UNKNOWN, px.END]
    assert spelled == -len(", Zebra")
