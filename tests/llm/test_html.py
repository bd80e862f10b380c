from __future__ import annotations

import html
import re

import numpy as np
from llm_fixtures import MIDDLE, entry  # noqa: F401

from caudal.llm import html_blocks as hb

PAGE = "page_id long, url string, html string"


def plain_text(page):
    """What stands in the article of a page of the sample tables."""
    inner = re.search(r"(?s)<article>(.*?)</article>", page)[1]
    parts = [" ".join(html.unescape(re.sub(r"<(?:b|br|/b)>", lambda m: " " if m[0] == "<br>" else "", p)).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(p for p in parts if p)


def test_query_equals_the_articles(entry, spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{MIDDLE}/pages.parquet").collect()}
    out = entry["op1_html_blocks"](spark, MIDDLE).collect()
    assert len(out) == len(pages)
    for r in out:
        assert r.url == pages[r.page_id].url and r.n_chars == len(r.text)
    assert [r.page_id for r in out if r.text != plain_text(pages[r.page_id].html)] == []


OTHER_LAYOUT = """<html><head><title>No</title><style>p{}</style></head><body><header><a href=/>Site name</a></header><div class="menu"><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></div>
<div class="cookie-notice">We use cookies on this site. <button>OK</button></div><div id="content"><h1>A headline of the story</h1>
<p>The first paragraph tells what happened, and it does so at some length, with commas &amp; stops.<p>A second one follows it; it isn&#39;t closed either, as is common on the web.
<blockquote>Someone said a thing that is quoted here in full.</blockquote><div class="ad">Buy now, cheap offers</div><p>The end of the story comes after the advert, as it often does.</p></div>
<aside class="sidebar"><a href=x>Other story</a> <a href=y>Third story</a></aside><section id="comments"><div class="comment"><p>I liked this one, thanks for it all.</p></div></section>
<form class="newsletter"><label>Mail</label><input><button>Send</button></form><footer>Copyright &copy; the site, all rights reserved.</footer></body></html>"""


def test_a_layout_the_table_does_not_have(spark):
    table = spark.read.parquet(f"{MIDDLE}/pages.parquet").select("page_id", "url", "html")
    extra = spark.createDataFrame([(-1, None, OTHER_LAYOUT)], PAGE)
    text = hb.extract(table.unionByName(extra)).where("page_id = -1").first().text
    for piece in ("The first paragraph", "commas & stops.", "A second one follows it; it isn't", "Someone said", "The end of the story"):
        assert piece in text
    for piece in ("Site name", "cookies", "Buy now", "Third story", "I liked", "Mail", "Copyright", "One", "p{}"):
        assert piece not in text


def test_held_out_layouts(spark):
    pages = [r.html for r in spark.read.parquet(f"{MIDDLE}/pages.parquet").orderBy("page_id").collect()]
    labeller = hb.train(pages[:120])
    r = np.random.default_rng(99)
    right = total = 0
    for page in pages[120:220]:
        found = hb.blocks(page)
        drawn, known = hb.drawn_layout([b.text for b, y in zip(found, hb.structure_labels(found)) if y], r)
        said = labeller.label([hb.vectors(drawn)])[0]
        right += int((said == (known > 0)).sum())
        total += len(known)
    assert right / total >= 0.95


def test_edges(spark):
    long = "<article>" + "<p>Some words of a long page.</p>" * 20_000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (None, "u", "plain text only"), (3, "u", "<p"), (4, "u", "<<<>>>&&&amp;"), (5, "u", long), (5, "u", long), (6, "u", "<script>alert(1)"), (7, "u", "<!-- never closed <p>x")]
    df = spark.createDataFrame(rows, PAGE).selectExpr("*", "'x' AS text", "1 AS n_chars")
    out = hb.extract(df).collect()
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    assert {r.page_id: r.text for r in out if r.page_id in (1, 2, 6, 7)} == {1: "", 2: "", 6: "", 7: ""}
    assert [len(r.text.split("\n")) for r in out if r.page_id == 5] == [20_000] * 2
    assert hb.extract(df.limit(0)).collect() == []


def test_blocks():
    texts = lambda page: [b.text for b in hb.blocks(page)]
    assert texts("a<b>b</b> c<br>d<p>e&nbsp; f<p>g") == ["ab c d", "e f", "g"]
    assert texts("<p>x<script>var t='</p>';</script>y</p><!-- z --><style>q</style>") == ["x y"]
    assert texts("<div title='a > b'>in</div>out&#x41;&lt;i&gt;") == ["in", "outA<i>"]
    assert texts("<ul><li>one<li>two<ul><li>deep</ul><li>three</ul>") == ["one", "two", "deep", "three"]
    assert texts("<select><option>hide</select><noscript>no</noscript>show") == ["show"]
    assert texts("1 < 2 and 3 > 2 <3") == ["1 < 2 and 3 > 2 <3"]
    path = hb.blocks("<body><nav class='main menu' id=top><a href=x>go</a></nav>")[0]
    assert path.path == ("body", "nav", "main", "menu", "top", "a") and path.linked == 2


def test_every_word_of_a_block_counts():
    spread = lambda words: hb.vectors([hb.Block(" ".join(words), ("p",), 0)])[0, hb.PATH_DIMS : hb.PATH_DIMS + hb.WORD_DIMS]
    first, late = ["same"] * 400, [f"word{i}" for i in range(1200)]
    want = (400 * spread(["same"]) + 1200 * spread(late)) / 1600
    assert np.allclose(spread(first + late), want, atol=1e-6) and np.allclose(spread(late + first), want, atol=1e-6)


def test_gradients():
    r = np.random.default_rng(0)
    lab = hb.Labeller()
    pages = [(r.standard_normal((n, hb.INPUT)).astype(np.float32), (r.random(n) > 0.5).astype(np.float32)) for n in (3, 5)]
    x, mask, y = hb.padded(pages)

    def loss():
        z = lab.logits(x, mask).astype(np.float64)
        return float(((np.logaddexp(0, z) - y * z) * mask).sum() / mask.sum())

    grads = lab.gradients(x, mask, y)
    for name in lab.p:
        flat = lab.p[name].reshape(-1)
        for k in r.integers(0, len(flat), 4):
            keep, step = flat[k], np.float32(1e-2)
            flat[k] = keep + step
            up = loss()
            flat[k] = keep - step
            down = loss()
            flat[k] = keep
            assert abs((up - down) / (2 * step) - grads[name].reshape(-1)[k]) < 2e-3
