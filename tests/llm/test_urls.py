from __future__ import annotations

import random
import re
import time
from itertools import combinations

from llm_fixtures import MIDDLE, entry  # noqa: F401
from pyspark.sql import functions as F

from caudal.llm import url_rules as ur

PAGE = "page_id long, url string, html string"


def plain_rule(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = "".join(c.lower() if c < "\x80" else c for c in m[1]) if m else ""
    path = m[2] if m else ""
    best = None
    for rule, verdict in ur.RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest) and (best is None or len(rule) > len(best[0])):
            best = rule, verdict
    return host, path, *(best or (None, None))


def test_fixed_rules_hosts_and_paths(entry, spark):
    pages = spark.read.parquet(f"{MIDDLE}/pages.parquet")
    rows = entry["op3_url_rules"](spark, MIDDLE).collect()
    urls = {r.page_id: r.url for r in pages.collect()}
    assert len(rows) == len(urls)
    for r in rows:
        host, path, rule, verdict = plain_rule(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.mined_rule else "allow"))
    assert {r.rule for r in rows} == {None, *(x for x, _ in ur.RULES)}


def test_edges(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.NET/en/x", "x://a.net", "x://net/", "x://anet/", "x://É.ORG/fr/y?q=1", "x://org/fr#z", "a://b://c.net/de/",
            "x://example.com/de/1", "x://sub.example.com/de", "x://example.net?en/", "x://u\nv.net/a\nb", "x://" + "a." * 3000 + "net/" + "p/" * 3000, "http://", "x://example.com:80/de/"]
    df = spark.createDataFrame([(i if i % 5 else None, u, None) for i, u in enumerate(urls)], PAGE).selectExpr("*", "'c' AS host", "'d' AS tokens", "'e' AS verdict", "1 AS n", "2 AS row")
    labels = spark.createDataFrame([(1, 0, None), (None, 1, 0), (1, 0, 1)], "doc_id long, quality int, toxic int")
    out = ur.judge_urls(df, labels).collect()
    want = sorted((plain_rule(u)[:3] for u in urls), key=str)
    assert sorted(((r.host, r.path, r.rule) for r in out), key=str) == want
    assert ur.judge_urls(df.limit(0), labels).collect() == []
    assert len(ur.judge_urls(df, labels.limit(0)).collect()) == len(urls)


def labelled_urls(n=600):
    r = random.Random(2)
    rows = []
    for i in range(n):
        bad = r.random() < 0.3
        words = [r.choice(["news", "shop", "blog"]), r.choice(["red", "blue"])] + (["casino", "win"] if bad else [r.choice(["casino", "win", "tea"])])
        rows.append((i, "http://" + ".".join(words) + f".example.org/p/{i}", bad))
    return rows


def test_mined_rules_equal_counting(spark):
    rows = labelled_urls()
    df = spark.createDataFrame(rows, "i long, url string, bad boolean").withColumns({"host": ur.host_of(), "path": ur.path_of()}).withColumn("tokens", ur.tokens_of())
    mined = {tuple(r.tokens): (r.confidence, r.support) for r in ur.mine(df.select("tokens", "bad"), support=0.02, confidence=0.9).collect()}
    sets = [(frozenset(r.tokens), r.bad) for r in df.select("tokens", "bad").collect()]
    all_tokens = sorted(set().union(*(s for s, _ in sets)))
    strong = {}
    for size in range(1, 7):
        for c in combinations(all_tokens, size):
            held = [b for s, b in sets if s.issuperset(c)]
            if held and sum(held) / len(sets) >= 0.02 and sum(held) / len(held) >= 0.9:
                strong[c] = (sum(held) / len(held), sum(held) / len(sets))
    smallest = {c for c in strong if not any(set(o) < set(c) for o in strong)}
    assert set(mined) == smallest and ("h:casino", "h:win") in mined
    assert all(abs(mined[c][0] - strong[c][0]) < 1e-9 and abs(mined[c][1] - strong[c][1]) < 1e-9 for c in mined)
    urls = df.select("url", "tokens").distinct()
    blocked = {r.url for r in ur.blocked_urls(urls, ur.mine(df.select("tokens", "bad"), 0.02, 0.9)).collect()}
    assert blocked == {r.url for r in urls.collect() if any(set(c) <= set(r.tokens) for c in mined)}


def test_plan_is_native(spark):
    pages, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("pages", "labels"))
    plan = ur.judge_urls(pages, labels)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)


def test_a_label_reaches_unlabelled_pages(spark):
    rows = labelled_urls()
    pages = spark.createDataFrame([(i, u, None) for i, u, _ in rows] + [(9999, "http://win.casino.example.org/x", None)], PAGE)
    labels = spark.createDataFrame([(i, 0 if bad else 1, 0) for i, _, bad in rows], "doc_id long, quality int, toxic int")
    got = {r.page_id: r.verdict for r in ur.judge_urls(pages, labels).collect()}
    assert got[9999] == "block"
    assert all(got[i] == "block" for i, u, bad in rows if bad)


def test_long_urls_are_mined_whole(spark):
    r = random.Random(4)
    rows = []
    for _ in range(600):
        bad = r.random() < 0.3
        own = ["h:casino", "h:win"] if bad else [r.choice(["h:casino", "h:win"])]
        rows.append((own + [f"p:f{i}" for i in range(18) if r.random() < 0.6], bad))
    mined = ur.mine(spark.createDataFrame(rows, "tokens array<string>, bad boolean"), support=0.05, confidence=0.9).collect()
    by = {tuple(x.tokens): x for x in mined}
    assert ("h:casino", "h:win") in by
    for c, x in by.items():
        held = [b for t, b in rows if set(c) <= set(t)]
        assert abs(x.confidence - sum(held) / len(held)) < 1e-9 and abs(x.support - sum(held) / len(rows)) < 1e-9


def test_equal_tokens_are_one_item(spark):
    """Thirty tokens that the same forty URLs share double nothing, and give the rules that counting gives."""
    r = random.Random(5)
    shared = [f"p:s{i:02d}" for i in range(30)]
    rows = [(["h:a"] + shared + (["p:x"] if i % 2 else ["p:y"]), i % 2 == 1) for i in range(40)]
    rows += [([r.choice(["h:a", "h:b"]), r.choice(["p:x", "p:y", "p:z"])], r.random() < 0.2) for _ in range(400)]
    df = spark.createDataFrame(rows, "tokens array<string>, bad boolean")
    ur.mine(df, 0.01, 0.9).count()
    start = time.time()
    mined = {tuple(x.tokens): (x.confidence, x.support) for x in ur.mine(df, 0.01, 0.9).collect()}
    assert time.time() - start < 30
    want = {}
    tokens = sorted({t for own, _ in rows for t in own})
    for size in (1, 2):
        for c in combinations(tokens, size):
            held = [b for own, b in rows if set(c) <= set(own)]
            if sum(held) >= 5 and sum(held) / len(held) >= 0.9 and not any(set(o) < set(c) for o in want):
                want[c] = (sum(held) / len(held), sum(held) / len(rows))
    assert {tuple(sorted(("p:x", s))) for s in shared} <= set(want)
    assert set(mined) == set(want) and all(abs(mined[c][0] - want[c][0]) < 1e-9 and abs(mined[c][1] - want[c][1]) < 1e-9 for c in want)
    rules, items = ur.mine_items(df, 0.01, 0.9)
    assert rules.count() == 1
    urls = spark.createDataFrame([("u", ["p:x", "p:s07"]), ("v", ["p:s07", "p:y"]), ("w", ["p:x"])], "url string, tokens array<string>")
    assert [x.url for x in ur.blocked_urls(ur.held_items(urls, items), rules).collect()] == ["u"]


def test_chance_makes_no_rule(spark):
    """A few bad URLs, or what is right no oftener than chance, make no rule."""
    few = [(["h:a", "p:x"], True)] * 4 + [(["h:b"], False)] * 400
    schema = "tokens array<string>, bad boolean"
    assert ur.mine(spark.createDataFrame(few, schema)).collect() == []
    often = [(["h:a"], True)] * 90 + [(["h:a"], False)] * 10
    assert ur.mine(spark.createDataFrame(often, schema)).collect() == []
    assert ur.mine(spark.createDataFrame([], schema)).collect() == []


def test_words_between_hyphens(spark):
    row = spark.createDataFrame([("Casino-win.example", "/Best-casino_win/12")], "host string, path string").select(ur.tokens_of().alias("t")).first()
    assert set(row.t) == {"h:Casino", "h:win", "h:example", "p:best", "p:casino", "p:win"}
