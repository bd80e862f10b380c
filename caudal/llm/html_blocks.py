"""Main text of web pages by a recurrent block labeller.

A page is cut into blocks, the stretches of text between block-level tags. Each block becomes a vector
of hashed tag-path tokens (names, classes and ids of the elements around it), hashed words and a few
measures. A bidirectional LSTM in numpy reads a page's blocks in order, so each block is labelled in
the light of the whole page; blocks labelled as content make up the text.

The labeller is fitted on a bounded sample of the table's own pages (``TRAIN_PAGES``, chosen by hash).
Labels come from structure: text inside an article or main element, less the menus, forms, adverts and
comments in it, is content. Pages say little about layouts that the table doesn't have, so the sampled
text is also set into layouts drawn at random, whose labels are known; there, class names are dropped at
random, which makes the labeller look at words, links and neighbours as well.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.text import in_small_batches

TRAIN_PAGES = 160
LAYOUTS, EPOCHS = 5, 8
PATH_DIMS, WORD_DIMS, MEASURES = 192, 32, 8
INPUT = PATH_DIMS + WORD_DIMS + MEASURES
HIDDEN = 16
PAGE_BATCH = 128

# Fixed values of HTML.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td "
    "tfoot th thead tr ul caption".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style noscript template textarea iframe xmp noembed noframes title".split())
HIDDEN_TAGS = frozenset("head select option datalist button svg math object audio video canvas map".split())
CLOSES_P = BLOCK_TAGS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "li", "dd", "dt", "caption"} | {"li", "dd", "dt"}
SELF_CLOSING = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
SCOPES = {"li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[A-Za-z]+")


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    linked: int


def _tokens(name: str, attributes: str) -> tuple[str, ...]:
    found = [name]
    for m in _NAMES.finditer(attributes):
        found += [p.lower() for p in _PART.findall(m[1] or m[2] or m[3] or "")[:12]]
    return tuple(found)


def blocks(page: str | None) -> list[Block]:
    """Blocks of a page in order, entities decoded and white space inside turned into single spaces.

    Markup, comments, scripts, styles and what is never shown are gone. Elements that HTML closes by
    itself are closed; what is left open at the end is taken as it is.
    """
    if not page:
        return []
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked: list[str] = []
    where: tuple[str, ...] = ()
    hidden = links = 0

    def flush() -> None:
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, where, len("".join("".join(linked).split()))))
            parts.clear()
            linked.clear()

    def text(raw: str) -> None:
        nonlocal where
        if raw and not hidden:
            if not parts or not any(p.strip() for p in parts):
                where = tuple(t for _, tokens in stack for t in tokens)
            parts.append(raw)
            if links:
                linked.append(raw)

    def pop(depth: int) -> None:
        nonlocal hidden, links
        if any(n in BLOCK_TAGS for n, _ in stack[depth:]):
            flush()
        for name, _ in stack[depth:]:
            hidden -= name in HIDDEN_TAGS
            links -= name == "a"
        del stack[depth:]

    def close_within(names: tuple[str, ...], scope: tuple[str, ...]) -> None:
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth][0] in names:
                return pop(depth)
            if stack[depth][0] in scope:
                return None

    at = 0
    while m := _TAG.search(page, at):
        text(page[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            if any(n == name for n, _ in stack):
                pop(max(d for d, (n, _) in enumerate(stack) if n == name))
            elif name in BLOCK_TAGS or name == "br":
                flush() if name != "br" else text(" ")
            continue
        if name in RAW_TAGS:
            end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
            stop = page.find(">", end.start()) if end else -1
            at = stop + 1 if stop >= 0 else len(page)
            text(" ")
            continue
        if name in ("br", "img", "wbr"):
            text(" " if name == "br" else "")
            continue
        if name in BLOCK_TAGS:
            flush()
        if name in CLOSES_P:
            close_within(("p",), ("table", "td", "th", "button", "object"))
        if name in SELF_CLOSING:
            close_within(SELF_CLOSING[name], SCOPES[name])
        if name in VOID_TAGS or (m[3] or "").endswith("/") and name not in BLOCK_TAGS | {"a"}:
            continue
        stack.append((name, _tokens(name, m[3] or "")))
        hidden += name in HIDDEN_TAGS
        links += name == "a"
    text(page[at:])
    flush()
    return out


def _bucket(token: str, size: int) -> int:
    return zlib.crc32(token.encode("utf-8", "replace")) % size


class _Buckets(dict):
    """Buckets of hashed tokens; emptied when full."""

    def __init__(self, size: int):
        self.size = size

    def __missing__(self, token: str) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[token] = _bucket(token, self.size)
        return value


_PATHS, _WORDS = _Buckets(PATH_DIMS), _Buckets(WORD_DIMS)


def vectors(found: list[Block]) -> np.ndarray:
    """One input vector for each block of a page."""
    x = np.zeros((len(found), INPUT), np.float32)
    for i, b in enumerate(found):
        for t in b.path:
            x[i, _PATHS[t]] = 1
        words = b.text.split(" ")
        n, chars = len(words), len(b.text)
        x[i, PATH_DIMS : PATH_DIMS + WORD_DIMS] = np.bincount([_WORDS[w] for w in words], minlength=WORD_DIMS) / n
        stops = sum(b.text.count(c) for c in ".,;!?")
        x[i, PATH_DIMS + WORD_DIMS :] = (
            np.log1p(n) / 4, min(b.linked / chars, 1.0), min(stops / n, 1.0), b.text[-1] in ".!?…\"”", b.text[0].isupper(),
            (i + 1) / len(found), np.log1p(chars / n) / 3, np.log1p(len(found)) / 5,
        )
    return x


class Labeller:
    """Bidirectional LSTM with a logistic output. Pages go in as ``(steps, pages, INPUT)`` with a mask."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        put = lambda *shape: (r.standard_normal(shape) * (1 / np.sqrt(shape[0]))).astype(np.float32)
        self.p = {}
        for d in "fb":
            self.p |= {f"{d}x": put(INPUT, 4 * HIDDEN), f"{d}h": put(HIDDEN, 4 * HIDDEN), f"{d}0": np.zeros(4 * HIDDEN, np.float32)}
            self.p[f"{d}0"][HIDDEN : 2 * HIDDEN] = 1
        self.p |= {"o": put(2 * HIDDEN), "ox": np.zeros(INPUT, np.float32), "o0": np.zeros(1, np.float32)}

    def _run(self, d: str, x: np.ndarray, mask: np.ndarray, keep: list | None) -> np.ndarray:
        steps, pages, _ = x.shape
        xs = x @ self.p[f"{d}x"] + self.p[f"{d}0"]
        h, c = (np.zeros((pages, HIDDEN), np.float32) for _ in range(2))
        out = np.empty((steps, pages, HIDDEN), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = xs[t] + h @ self.p[f"{d}h"]
            gate = 1 / (1 + np.exp(-z[:, : 3 * HIDDEN]))
            i, f, o = gate[:, :HIDDEN], gate[:, HIDDEN : 2 * HIDDEN], gate[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            c_new = f * c + i * g
            tc = np.tanh(c_new)
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, tc, m))
            c = m * c_new + (1 - m) * c
            h = m * (o * tc) + (1 - m) * h
            out[t] = h
        return out

    def logits(self, x: np.ndarray, mask: np.ndarray, kept: dict | None = None) -> np.ndarray:
        keep = {d: [] if kept is not None else None for d in "fb"}
        both = np.concatenate([self._run(d, x, mask, keep[d]) for d in "fb"], axis=2)
        if kept is not None:
            kept.update(keep, both=both)
        return both @ self.p["o"] + x @ self.p["ox"] + self.p["o0"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        kept: dict = {}
        z = self.logits(x, mask, kept)
        dz = ((1 / (1 + np.exp(-z)) - y) * mask / max(mask.sum(), 1)).astype(np.float32)
        g = {"o": np.einsum("tp,tph->h", dz, kept["both"]), "ox": np.einsum("tp,tpi->i", dz, x), "o0": np.array([dz.sum()], np.float32)}
        dboth = dz[:, :, None] * self.p["o"]
        for d, part in (("f", dboth[:, :, :HIDDEN]), ("b", dboth[:, :, HIDDEN:])):
            wh = self.p[f"{d}h"]
            g[f"{d}h"] = np.zeros_like(wh)
            gates = np.zeros((len(x), x.shape[1], 4 * HIDDEN), np.float32)
            dh, dc = (np.zeros((x.shape[1], HIDDEN), np.float32) for _ in range(2))
            for t, h, c, i, f, o, gg, tc, m in reversed(kept[d]):
                dh = dh + part[t]
                own = m * dh
                dcell = m * dc + own * o * (1 - tc * tc)
                dgate = np.concatenate([dcell * gg * i * (1 - i), dcell * c * f * (1 - f), own * tc * o * (1 - o), dcell * i * (1 - gg * gg)], 1)
                gates[t] = dgate
                g[f"{d}h"] += h.T @ dgate
                dh = (1 - m) * dh + dgate @ wh.T
                dc = (1 - m) * dc + dcell * f
            g[f"{d}x"] = np.einsum("tpi,tpg->ig", x, gates, optimize=True)
            g[f"{d}0"] = gates.sum((0, 1))
        return g

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = 11, batch: int = 32) -> None:
        """Adam over batches of pages of like length."""
        r = np.random.default_rng(seed)
        m1 = {k: np.zeros_like(v) for k, v in self.p.items()}
        m2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        order = sorted(range(len(pages)), key=lambda k: len(pages[k][1]))
        groups = [order[i : i + batch] for i in range(0, len(order), batch)]
        step = 0
        for _ in range(epochs):
            for k in r.permutation(len(groups)):
                x, mask, y = padded([pages[i] for i in groups[k]])
                step += 1
                for name, grad in self.gradients(x, mask, y).items():
                    m1[name] = 0.9 * m1[name] + 0.1 * grad
                    m2[name] = 0.99 * m2[name] + 0.01 * grad * grad
                    rate = 0.02 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                    self.p[name] -= (rate * m1[name] / (np.sqrt(m2[name]) + 1e-7)).astype(np.float32)

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Which blocks of each page are content."""
        out: list = [np.zeros(0, bool)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        for low in range(0, len(order), PAGE_BATCH):
            own = order[low : low + PAGE_BATCH]
            x, mask, _ = padded([(pages[k], np.zeros(len(pages[k]))) for k in own])
            z = self.logits(x, mask)
            for j, k in enumerate(own):
                out[k] = z[: len(pages[k]), j] > 0
        return out


def padded(pages: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    steps = max(len(y) for _, y in pages)
    x = np.zeros((steps, len(pages), INPUT), np.float32)
    mask, y = np.zeros((steps, len(pages)), np.float32), np.zeros((steps, len(pages)), np.float32)
    for k, (own, label) in enumerate(pages):
        x[: len(label), k], mask[: len(label), k], y[: len(label), k] = own, 1, label
    return x, mask, y


# Words in tag paths that structure labels and drawn layouts go by.
CONTENT_NAMES = ("article", "main")
OTHER_NAMES = frozenset(
    "nav menu header footer aside sidebar ad ads advert advertisement banner promo sponsored sponsor cookie consent notice alert form "
    "comment comments discussion replies breadcrumb breadcrumbs related share social newsletter subscribe login search pagination widget "
    "toolbar copyright disclaimer popup modal".split()
)


def structure_labels(found: list[Block]) -> np.ndarray | None:
    """Content by structure, or None where a page has no article or main element."""
    if not any(n in b.path for b in found for n in CONTENT_NAMES):
        return None

    def content(path: tuple[str, ...]) -> bool:
        at = [k for k, t in enumerate(path) if t in CONTENT_NAMES]
        return bool(at) and not OTHER_NAMES & set(path[at[0] + 1 :])

    return np.array([content(b.path) for b in found], np.float32)


_WRAPS = (
    ("article",), ("main",), ("div", "content"), ("div", "main content"), ("div", "post"), ("section", "article body"), ("div", "entry content"),
    ("div", "story"), ("div", "text"), ("main", "page"), ("div", "article"), ("div", "post body"), ("section", "content"), ("div", "page main"), ("td", "content"),
)
_NOISE = {
    "top": (("header",), ("div", "header"), ("nav",), ("div", "menu"), ("div", "navbar"), ("ul", "nav"), ("div", "breadcrumb"), ("div", "cookie notice"),
            ("div", "banner"), ("div", "ad"), ("form", "search"), ("div", "topbar"), ("div", "alert"), ("div", "masthead"), ("section", "notice"), ("div", "consent")),
    "side": (("aside",), ("div", "sidebar"), ("aside", "sidebar widget"), ("div", "advert"), ("div", "promo"), ("div", "sponsored"), ("div", "related"),
             ("div", "newsletter form"), ("form", "login"), ("div", "ads"), ("div", "widget"), ("div", "notice"), ("div", "share social")),
    "end": (("footer",), ("div", "footer"), ("section", "comments"), ("div", "comments"), ("ul", "comment list"), ("div", "related posts"), ("nav", "pagination"),
            ("div", "copyright"), ("form", "comment form"), ("div", "disclaimer"), ("div", "ad banner"), ("div", "site footer"), ("div", "replies discussion")),
}


def drawn_layout(texts: list[str], r: np.random.Generator) -> tuple[list[Block], np.ndarray]:
    """A page in a layout drawn at random, with ``texts`` as its content and as its noise."""
    found: list[Block] = []
    labels: list[float] = []
    pick = lambda options: options[int(r.integers(len(options)))]
    words = " ".join(texts).split()

    def phrase(low: int, high: int) -> str:
        n, at = int(r.integers(low, high)), int(r.integers(0, max(1, len(words))))
        return " ".join((words[at : at + n] or ["Menu"]))

    def put(text: str, path: tuple[str, ...], linked: float, label: float) -> None:
        if text:
            found.append(Block(text, path, int(linked * len(text))))
            labels.append(label)

    shell = ("html", "body", *(pick(((), ("div",), ("div", "wrapper"), ("div", "container"), ("div", "page"), ("table", "tr", "td"))),)[0])

    def path(wrap: tuple[str, ...], around: tuple[str, ...] | None = None) -> tuple[str, ...]:
        names = " ".join(wrap[1:]).split()
        if r.random() < 0.15 and wrap[0] in ("div", "section", "ul", "td"):
            names = []
        return (*(shell if around is None else around), wrap[0], *names)

    def noise(wrap: tuple[str, ...], around: tuple[str, ...] | None = None) -> None:
        names = set(" ".join(wrap).split())
        own = path(wrap, around)
        if names & {"comments", "comment", "replies"} and "form" not in names:
            for _ in range(int(r.integers(1, 6))):
                put(phrase(1, 5), (*own, "li", "comment"), 0.5, 0)
                put(phrase(4, 40), (*own, pick(("li", "div")), "comment", "p"), 0, 0)
        elif names & {"ad", "ads", "advert", "promo", "sponsored", "cookie", "notice", "alert", "banner", "consent", "disclaimer", "copyright", "footer"}:
            inner = pick(((), ("p",), ("div",)))
            for _ in range(int(r.integers(1, 3))):
                put(pick(texts).split(". ")[0] if r.random() < 0.3 else phrase(2, 25), (*own, *inner), pick((0, 0, 0.3, 1)), 0)
        elif "form" in names:
            put(phrase(1, 4), (*own, "label"), 0, 0)
        else:
            for _ in range(int(r.integers(1, 9))):
                put(phrase(1, 6), (*own, pick(("ul", "div", "ol")), "li", "a"), 1, 0)

    def some(kind: str, chance: float) -> None:
        for wrap in _NOISE[kind]:
            if r.random() < chance:
                noise(wrap)

    some("top", 0.22)
    if r.random() < 0.35:
        some("side", 0.15)
    wrap = pick(_WRAPS)
    main = path(wrap)
    if r.random() < 0.8:
        put(phrase(3, 14), (*main, *(("header",) if r.random() < 0.15 else ()), pick(("h1", "h2"))), 0, 1)
    for k, text in enumerate(texts):
        inner = pick((("p",),) * 8 + (("blockquote", "p"), ("ul", "li"), ("pre",), ("div",), ("h2",), ("h3",)))
        put(text if inner[0] not in ("h2", "h3", "li") else phrase(2, 9), (*main, *inner), 0.15 * (r.random() < 0.2), 1)
        if r.random() < 0.12:
            noise(pick((("div", "ad"), ("div", "advert"), ("aside",), ("div", "related"), ("div", "promo"), ("div", "newsletter form"), ("div", "notice"), ("nav",))), main)
    if r.random() < 0.15:
        for _ in range(int(r.integers(1, 4))):
            put(phrase(4, 40), (*main, pick(("section", "div")), "comments", "p"), 0, 0)
    some("side", 0.12)
    some("end", 0.25)
    return found, np.array(labels, np.float32)


def train(pages: list[str], seed: int = 5) -> Labeller:
    """A labeller from whole pages: their own structure, and their text in drawn layouts."""
    r = np.random.default_rng(seed)
    rows: list[tuple[np.ndarray, np.ndarray]] = []
    for page in pages:
        found = blocks(page)[:200]
        if not found:
            continue
        labels = structure_labels(found)
        if labels is not None:
            rows.append((vectors(found), labels))
        texts = [b.text for b, y in zip(found, labels if labels is not None else np.ones(len(found))) if y]
        for _ in range(LAYOUTS):
            some = texts[: int(r.integers(1, 1 + min(len(texts), 30)))] if texts else ["Text."]
            drawn, known = drawn_layout(some, r)
            if drawn:
                rows.append((vectors(drawn), known))
    labeller = Labeller()
    if rows:
        labeller.fit(rows)
    return labeller


def extract(pages: DataFrame, sample: int = TRAIN_PAGES) -> DataFrame:
    """``(page_id, url, text, n_chars)``, one row for each row of ``pages``.

    A null or empty html, or one without content, gives an empty text. Repeated rows give equal texts. The labeller
    is fitted on ``sample`` pages, chosen by hash among those that have html.
    """
    rows = in_small_batches(pages).select("page_id", "url", F.col("html").cast("string").alias("html"))
    chosen = rows.where("html != ''").orderBy(F.xxhash64("html"), "html").select(F.substring("html", 1, 1 << 17)).limit(sample).collect()
    labeller = train([r[0] for r in chosen])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for low in range(0, len(batch), 1024):
                found = [blocks(h) for h in batch["html"].iloc[low : low + 1024]]
                for own, keep in zip(found, labeller.label([vectors(f) for f in found])):
                    out.append("\n".join(b.text for b, k in zip(own, keep) if k))
            yield batch[["page_id", "url"]].assign(text=out, n_chars=[len(t) for t in out])

    kinds = dict(rows.dtypes)
    return rows.mapInPandas(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
