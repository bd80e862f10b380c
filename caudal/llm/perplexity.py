"""Text quality by counts and by the perplexity of an n-gram model.

The model is an interpolated modified Kneser-Ney model of pairs of words, one for each language, counted by Spark.
Words, marks and digits are tokens in lower case; a mark of its own goes before a capital, so that the model
knows where sentences start. A letter of a script without blanks is a word. The ``VOCABULARY`` most frequent
words of a language have numbers; any other is one token times how it is spelled, by a modified Kneser-Ney
4-gram model over characters folded to 64 symbols.

Texts are kept as blocks of token numbers. A block sends its distinct pairs, sorted and delta-coded, to parts of the
hash range, which add them up and answer how often the corpus has each. Pairs grow with the corpus and are never in
one place; what a word needs (how often it leads, by how many followers, after how many leaders) is bounded by the
vocabulary and broadcast. Equal texts of a block are counted once.

A text is scored as if the model had not seen it: its own pairs are taken off counts, totals and kinds of leaders.

A document is rejected when its log perplexity lies outside the band of its language: ``HIGH_WIDTH`` times the span
from the median to the third quartile above that, ``LOW_WIDTH`` times the span from the first to the median below
the first, over distinct texts. The lower bound only meets text whose next word is all but certain. The upper bound
of a document is no higher than its log perplexity by words alone less the gain that word order brings at least:
``GAIN_WIDTH`` spans below the first quartile of that gain. So words in random order are rejected, rare or not.
"""

from __future__ import annotations

import re
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caudal.llm.text import WordHashes, in_small_batches, mix, window_hashes
from caudal.session import materialise

ORDER, BITS = 4, 6
SYMBOLS = 1 << BITS
LANGUAGES = 32
OTHER = "*"
HIGH_WIDTH, LOW_WIDTH, GAIN_WIDTH = 3.0, 8.0, 2.25
# Bands are never narrower than this to either side of the quartiles.
BAND_LEAST = 0.35
FLUSH = 8_000_000
# Distinct words that a task holds before it hands its counts on.
WORDS_FLUSH = 400_000
# Token numbers: begin, end, mark of a capital, a word without a number; then words by falling count.
BEGIN, END, CAPITAL, UNKNOWN, FIRST = range(5)
VOCABULARY = (1 << 16) - FIRST
# Code points of a block of texts, and those whose pairs a part of the hash range holds on average.
BLOCK, PART = 12_000_000, 32_000_000
# Scripts that set no blanks between words: every letter and mark is a word.
_UNSPACED = ((0x0E00, 0x0F00), (0x1000, 0x10A0), (0x1780, 0x1800), (0x3000, 0x3100), (0x3400, 0xA000), (0xF900, 0xFB00), (0xFF00, 0xFFF0), (0x20000, 0x40000))
_ALONE = "".join(f"{chr(a)}-{chr(b - 1)}" for a, b in _UNSPACED)
TOKEN = re.compile(rf"[{_ALONE}]|[^\W{_ALONE}]+|[^\w\s]")


@lru_cache(maxsize=1)
def _symbols() -> np.ndarray:
    """Symbol of every code point: 0 white space, 1-26 a-z, 27 digits, 28-35 common marks, else hashed."""
    out = (36 + mix(np.arange(sys.maxunicode + 1, dtype=np.uint64)) % np.uint64(SYMBOLS - 36)).astype(np.uint8)
    out[[9, 10, 11, 12, 13, 32, 0xA0]] = 0
    out[97:123] = out[65:91] = np.arange(1, 27)
    out[48:58] = 27
    out[[ord(c) for c in ".,;:!?'-"]] = np.arange(28, 36)
    return out


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every code point: 1 if a token of its own, 2 if part of a longer one, else 0; a hash of it in lower case; is it a capital."""
    n = sys.maxunicode + 1
    word, space, capital = (np.fromiter(map(f, map(chr, range(n))), bool, n) for f in (str.isalnum, str.isspace, str.isupper))
    word[ord("_")] = True
    kind = np.where(space, 0, np.where(word, 2, 1)).astype(np.uint8)
    for a, b in _UNSPACED:
        kind[a:b] = 1
    lower = np.arange(n, dtype=np.uint64)
    lower[:_CASED] = [ord(x) if len(x) == 1 else ord(c) for c, x in ((chr(c), chr(c).lower()) for c in range(_CASED))]
    return kind, mix(lower + np.uint64(1)), capital


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
# No code point from here on has a lower case.
_CASED = 0x20000
# Letters whose lower case depends on their neighbours or is longer.
_ODD_CAPITALS = (0x0130, 0x03A3)


# Values that are hashed at once.
_STRETCH = 1 << 18


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.cumprod(np.r_[np.uint64(1), np.full(_STRETCH, b, np.uint64)]) for b in (_BASE, _INVERSE))


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of ``values``, which are hashes themselves: equal runs have equal hashes wherever they stand."""
    power, inverse = _powers()
    if len(values) <= _STRETCH:
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * power[: len(values)], out=total[1:])
        sums = (total[ends] - total[starts]) * inverse[starts]
    elif len(starts) > 1:
        half = len(starts) // 2
        cut = starts[half]
        return np.concatenate([run_hashes(values[:cut], starts[:half], ends[:half]), run_hashes(values[cut:], starts[half:] - cut, ends[half:] - cut)])
    else:
        sums = np.zeros(len(starts), np.uint64)
        for a, b in zip(starts.tolist(), ends.tolist()):
            parts = ((values[k : min(k + _STRETCH, b)], pow(_BASE, k - a, 1 << 64)) for k in range(a, b, _STRETCH))
            sums[:] = sum(int((v * power[: len(v)]).sum()) * by for v, by in parts) % (1 << 64)
    return mix(sums + (ends - starts).astype(np.uint64))


def token_runs(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the tokens of a text begin and end, and their hashes in lower case."""
    kind, folded, _ = _tables()
    own = kind[code]
    inside = np.zeros(len(code) + 2, bool)
    inside[1:-1] = own == 2
    single = own == 1
    starts = np.flatnonzero(single | (inside[1:-1] & ~inside[:-2]))
    ends = np.flatnonzero(single | (inside[1:-1] & ~inside[2:])) + 1
    hashes = run_hashes(folded[code], starts, ends)
    odd = np.flatnonzero((code == _ODD_CAPITALS[0]) | (code == _ODD_CAPITALS[1]))
    if len(odd):
        for k in np.unique(np.searchsorted(starts, odd, "right") - 1).tolist():
            token = _codes(code[starts[k] : ends[k]].tobytes().decode("utf-32-le", "surrogatepass").lower())
            hashes[k] = run_hashes(folded[token], np.array([0]), np.array([len(token)]))[0]
    return starts, ends, hashes


def grams(text: str | None) -> np.ndarray:
    """The packed 4-gram that ends at each character, after three leading blanks."""
    if not text:
        return np.empty(0, np.uint32)
    return _grams_of(_codes(text.lower()))


def _grams_of(code: np.ndarray) -> np.ndarray:
    s = np.zeros(len(code) + ORDER - 1, np.uint32)
    s[ORDER - 1 :] = _symbols()[code]
    n = len(code)
    return (s[:n] << 18) | (s[1 : n + 1] << 12) | (s[2 : n + 2] << 6) | s[3 : n + 3]


def _discounts(counts: np.ndarray) -> np.ndarray:
    """Discounts for counts of one, two and more."""
    return _discounts_of([int((counts == k).sum()) for k in (1, 2, 3, 4)])


def _discounts_of(n: list[int]) -> np.ndarray:
    """Discounts from how many counts are one, two, three and four."""
    if min(n[:3]) == 0:
        return np.array([0.5, 0.75, 0.9])
    y = n[0] / (n[0] + 2 * n[1])
    raw = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    return np.clip(raw, 0.05, [0.95, 1.9, 2.9])


@dataclass
class Level:
    """Interpolated log probabilities by packed n-gram, and log weights of backing off by context."""

    keys: np.ndarray
    logp: np.ndarray
    contexts: np.ndarray
    backoff: np.ndarray


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Model:
    """Modified Kneser-Ney from sorted distinct 4-grams and their counts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, words: np.ndarray = np.empty(0, np.uint64)):
        """``words`` are the hashes of the words with numbers, in the order of these."""
        rank = np.argsort(words)
        self.words, self.numbers = words[rank], rank + FIRST
        tables = [(keys.astype(np.uint32), counts.astype(np.int64))]
        for order in range(ORDER - 1, 0, -1):  # a lower order counts what it follows
            tail = tables[0][0] & np.uint32((1 << (BITS * order)) - 1)
            tables.insert(0, np.unique(tail, return_counts=True))
        self.levels: list[Level] = []
        for order, (k, c) in enumerate(tables, 1):
            d = _discounts(c)
            context = k >> np.uint32(BITS)
            first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(k) else np.empty(0, int)
            kinds = np.minimum(c, 3)
            total = np.add.reduceat(c, first) if len(k) else c
            lost = np.add.reduceat(d[kinds - 1], first) if len(k) else d[:0]
            gamma = lost / np.maximum(total, 1)
            group = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(k)]))
            p = (c - d[kinds - 1]) / total[group] + gamma[group] * np.exp(self._log(k & np.uint32((1 << (BITS * (order - 1))) - 1), order - 1))
            self.levels.append(Level(k, np.log(p).astype(np.float32), context[first], np.log(gamma).astype(np.float32)))
        self.counts, self.totals = tables[-1][1].astype(np.int32), np.add.reduceat(tables[-1][1], first) if len(keys) else counts

    def _log(self, gram: np.ndarray, order: int) -> np.ndarray:
        if order == 0:
            return np.full(len(gram), -np.log(SYMBOLS))
        level = self.levels[order - 1]
        at, found = _find(level.keys, gram)
        out = level.logp[at].astype(np.float64) if len(level.keys) else np.zeros(len(gram))
        if not found.all():
            miss = gram[~found]
            here, known = _find(level.contexts, miss >> np.uint32(BITS))
            weight = np.where(known, level.backoff[here] if len(level.contexts) else 0.0, 0.0)
            out[~found] = weight + self._log(miss & np.uint32((1 << (BITS * (order - 1))) - 1), order - 1)
        return out

    def log_perplexity(self, text: str | None) -> float | None:
        """Mean negative log probability of a character; None for a text without any."""
        g = grams(text)
        return float(-self.logs(g).mean()) if len(g) else None

    def logs(self, g: np.ndarray) -> np.ndarray:
        """Log probability of each character of a text with the n-grams ``g``."""
        own, where, n = np.unique(g, return_inverse=True, return_counts=True)
        log, top = self._log(own, ORDER), self.levels[-1]
        context = own >> np.uint32(BITS)
        first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
        held = np.repeat(np.add.reduceat(n, first), np.diff(np.r_[first, len(own)]))
        at, found = _find(top.keys, own)
        alone = found & (self.counts[at] <= n if len(top.keys) else found)
        if alone.any():
            here, known = _find(top.contexts, context[alone])
            others = known & (self.totals[here] > held[alone])
            lower = self._log(own[alone] & np.uint32((1 << (BITS * (ORDER - 1))) - 1), ORDER - 1)
            log[alone] = np.where(others, top.backoff[here], 0.0) + lower
        return log[where]


def _model_of(lang, known: frozenset) -> str:
    name = "und" if lang is None or lang != lang else str(lang)
    return name if name in known else OTHER


def _word_hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))


def _counter(known: frozenset):
    def added(held: tuple | None, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        k, c = np.unique(np.concatenate(parts), return_counts=True)
        if held is None:
            return k, c
        both, at = np.unique(np.concatenate([held[0], k]), return_inverse=True)
        return both, np.bincount(at, np.concatenate([held[1], c]), len(both)).astype(np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[bool, dict[str, tuple]] = {False: {}, True: {}}  # by whether words

        def flush(word: bool) -> Iterator[pd.DataFrame]:
            for model, (k, c) in sums[word].items():
                yield pd.DataFrame({"model": model, "word": word, "gram": k.astype(np.uint64).view(np.int64), "n": c})
            sums[word].clear()

        for batch in batches:
            by: dict[str, tuple[list, list]] = {}
            size = 0
            for last, (lang, text) in enumerate(zip(batch["lang"], batch["text"]), 1 - len(batch)):
                if text:
                    code = _codes(text.lower())
                    parts = by.setdefault(_model_of(lang, known), ([], []))
                    parts[0].append(_grams_of(code))
                    parts[1].append(token_runs(code)[2])
                    size += len(code)
                if size >= 1 << 20 or last == 0:
                    for model, parts in by.items():
                        for word in (False, True):
                            sums[word][model] = added(sums[word].get(model), parts[word])
                    by, size = {}, 0
            for word, most in ((False, FLUSH), (True, WORDS_FLUSH)):
                if sum(len(k) for k, _ in sums[word].values()) >= most:
                    yield from flush(word)
        for word in (False, True):
            yield from flush(word)

    return run


def _vocabulary(counted: DataFrame) -> DataFrame:
    """The words with numbers: all of the highest counts, two at least, that ``VOCABULARY`` of a model reach."""
    n = F.least("n", F.lit(1 << 20))
    words = counted.where("word AND n >= 2")
    reach = F.sum("c").over(Window.partitionBy("model").orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0))
    least = (
        words.groupBy("model", n.alias("n")).agg(F.count(F.lit(1)).alias("c")).withColumn("reach", reach)
        .where(F.col("reach") <= VOCABULARY).groupBy("model").agg(F.min("n").alias("least"))
    )
    # One row for each model, LANGUAGES + 1 at most.
    return words.join(F.broadcast(least), "model").where("n >= least")


def fit(documents: DataFrame) -> dict[str, Model]:
    """A model for each of the ``LANGUAGES`` most frequent languages, null as ``und``; one for the rest.

    ``documents`` has ``lang`` and ``text``; every text is counted. A model holds the spelling and the numbers of words.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    top = documents.groupBy(lang.alias("l")).count().orderBy(F.desc("count"), "l").limit(LANGUAGES).collect()
    known = frozenset(r[0] for r in top)
    counted = (
        documents.select("lang", "text")
        .mapInPandas(_counter(known), "model string, word boolean, gram long, n long")
        .groupBy("model", "word", "gram")
        .agg(F.sum("n").alias("n"))
    )
    table = materialise(counted)
    vocabulary = _vocabulary(table).select("model", "gram", "n").toPandas().sort_values(["n", "gram"], ascending=[False, True])
    models = {}
    for (name,) in table.select("model").distinct().orderBy("model").collect():
        rows = table.where((F.col("model") == name) & ~F.col("word")).select("gram", "n").toArrow()
        keys, n = rows["gram"].to_numpy().astype(np.uint32), rows["n"].to_numpy()
        order = np.argsort(keys)
        words = vocabulary.loc[vocabulary["model"] == name, "gram"].to_numpy(np.int64).view(np.uint64)
        models[name] = Model(keys[order], n[order], words)
    return models


def _runs_of_words(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(code) + 2, bool)
    inside[1:-1] = (code != 32) & ((code < 9) | (code > 13))
    return np.flatnonzero(inside[1:-1] & ~inside[:-2]), np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1


def base_figures(text: str | None, _: WordHashes | None = None, code: np.ndarray | None = None) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of a whole text; zeros for null. ``code`` are its code points."""
    if not text:
        return 0, 0, 0, 0, 0
    code = _codes(text) if code is None else code
    starts, ends = _runs_of_words(code)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    repeated = 0
    if len(starts) > 8:
        h = window_hashes(run_hashes(code + np.uint64(1), starts, ends), 8)
        rank = np.sort(h)
        again = rank[1:][rank[1:] == rank[:-1]]
        if len(again):
            twice = np.flatnonzero(again[np.minimum(np.searchsorted(again, h), len(again) - 1)] == h)
            edge = np.zeros(len(starts) + 1, np.int32)
            np.add.at(edge, twice, 1)
            np.add.at(edge, twice + 8, -1)
            repeated = int((np.cumsum(edge[:-1]) > 0).sum())
    return len(starts), int((ends - starts).sum()), symbols, len(lines) - len(set(lines)), repeated


def encoded(text: str, model: Model, code: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Token numbers of a text from begin to end, and the log probability of how unknown words are spelled."""
    code = _codes(text) if code is None else code
    starts, ends, hashes = token_runs(code)
    at, known = _find(model.words, hashes)
    number = np.where(known, model.numbers[at], UNKNOWN) if len(model.words) else np.full(len(starts), UNKNOWN)
    capital = _tables()[2][code[starts]]
    out = np.full(len(starts) + int(capital.sum()) + 2, CAPITAL, np.uint16)
    out[0], out[-1] = BEGIN, END
    out[np.arange(1, len(starts) + 1) + np.cumsum(capital)] = number
    unknown = np.flatnonzero(number == UNKNOWN)
    spelled = model.logs(grams(" ".join([text[a:b] for a, b in zip(starts[unknown].tolist(), ends[unknown].tolist())]))).sum() if len(unknown) else 0.0
    return out, float(spelled)


def _pack(values: np.ndarray) -> bytes:
    """64-bit values by planes of bytes, compressed: high planes of small values vanish."""
    return zstandard.compress(np.ascontiguousarray(values.astype(np.int64).view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpack(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(8, -1).T).view(np.int64).ravel()


_META = ["doc_id", "no_id", "model", "digest", "spelled", "tokens", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _encoder(shared, names: list[str]):
    known, index = frozenset(names), {n: i for i, n in enumerate(names)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models = shared.value
        meta, tokens, size = [], [], 0

        def flush() -> pd.DataFrame:
            row = uuid.uuid4().int >> 65, _pack(np.array(meta, np.int64).ravel()), _pack(np.concatenate([np.empty(0, np.uint16), *tokens]))
            meta.clear()
            tokens.clear()
            return pd.DataFrame([row], columns=["block", "meta", "tokens"])

        for batch in batches:
            for doc_id, lang, text in zip(batch["doc_id"], batch["lang"], batch["text"]):
                model, ids, spelled, digest, code = _model_of(lang, known), (), 0.0, 0, None
                if text:
                    code = _codes(text)
                    ids, spelled = encoded(text, models[model], code)
                    tokens.append(ids)
                    digest = np.uint64(_word_hash(text)).view(np.int64)
                lacking = bool(pd.isna(doc_id))
                meta.append([
                    0 if lacking else int(doc_id), lacking, index.get(model, -1), digest, np.float64(spelled).view(np.int64), len(ids),
                    *base_figures(text, code=code),
                ])
                size += len(text or "") + 64
                if size >= BLOCK:
                    yield flush()
                    size = 0
        if meta:
            yield flush()

    return run


@dataclass
class Pairs:
    """The pairs of tokens of a block: distinct keys in the order of parts, and by document."""

    meta: pd.DataFrame
    keys: np.ndarray  # model, leader and follower in 16 bits each
    parts: np.ndarray
    doc: np.ndarray  # each document's distinct pairs: the document, the place of the key, how often
    at: np.ndarray
    n: np.ndarray


def pairs_of(meta: bytes, tokens: bytes, parts: int) -> Pairs:
    docs = pd.DataFrame(_unpack(meta).reshape(-1, len(_META)), columns=_META)
    ids, length = _unpack(tokens), docs["tokens"].to_numpy()
    of = np.repeat(np.arange(len(docs)), length)
    inside = of[1:] == of[:-1]
    key = (docs["model"].to_numpy()[of[1:]] << 32 | ids[:-1] << 16 | ids[1:])[inside]
    keys, at = np.unique(key, return_inverse=True)
    part = (mix(keys.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    place = np.empty(len(keys), np.int64)
    place[order] = np.arange(len(keys))
    width = max(len(keys), 1)
    own, n = np.unique(of[1:][inside] * width + place[at], return_counts=True)
    return Pairs(docs, keys[order], part[order], own // width, own % width, n)


def _sender(parts: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, meta, tokens in zip(batch["block"], batch["meta"], batch["tokens"]):
                p = pairs_of(meta, tokens, parts)
                first = (~p.meta.duplicated(["model", "digest"])).to_numpy()[p.doc]
                counts = np.bincount(p.at[first], p.n[first], len(p.keys)).astype(np.int64)
                edge = [0, *(np.flatnonzero(np.diff(p.parts)) + 1), len(p.keys)]
                rows = [
                    (block, int(p.parts[a]), _pack(np.diff(p.keys[a:b], prepend=0)), _pack(counts[a:b])) for a, b in zip(edge, edge[1:]) if a < b
                ]
                for i in range(0, len(rows), 64):
                    yield pd.DataFrame(rows[i : i + 64], columns=["block", "part", "keys", "counts"])

    return run


_SUMS = ["total", "one", "two", "more", "leaders"]


def _corpus_counts(group: pd.DataFrame) -> pd.DataFrame:
    """How often all blocks have the pairs that each sent, and what this part adds to the sums of words.

    A word's number is below ``1 << 16`` after its model. Under ``-1 - model`` stand how many pairs occur once to four times.
    """
    keys = [np.cumsum(_unpack(x)) for x in group["keys"]]
    ends = np.cumsum([len(k) for k in keys])
    every, at = np.unique(np.concatenate(keys), return_inverse=True)
    del keys
    total = np.bincount(at, np.concatenate([_unpack(x) for x in group["counts"]])).astype(np.int64)
    answers = pd.DataFrame({"block": group["block"], "part": group["part"], "counts": [_pack(total[x]) for x in np.split(at, ends[:-1])]})
    del at
    # Pairs are sorted by model and leader: sums of both are those of runs.
    leader, model = every >> 16, every >> 32
    first, first_of_model = (np.flatnonzero(np.diff(x, prepend=-1)) for x in (leader, model))
    follower, leaders = np.unique(model << 16 | every & 0xFFFF, return_counts=True)
    lead = leader[first]
    word = np.union1d(lead, follower)
    sums = {f: np.zeros(len(word), np.int64) for f in _SUMS}
    at_lead = np.searchsorted(word, lead)
    for f, x in (("total", total), ("one", total == 1), ("two", total == 2), ("more", total >= 3)):
        sums[f][at_lead] = np.add.reduceat(x, first, dtype=np.int64)
    sums["leaders"][np.searchsorted(word, follower)] = leaders
    kinds = {f: np.add.reduceat(total == k, first_of_model, dtype=np.int64) for k, f in enumerate(_SUMS[1:], 1)}
    of_count = pd.DataFrame({"word": -1 - model[first_of_model], "total": 0, **kinds})
    words = pd.concat([pd.DataFrame({"word": word, **sums}), of_count])
    # Whole numbers with gaps: as floats, the names of blocks would lose digits.
    whole = {c: "Int64" for c in ("block", "part", "word", *_SUMS)}
    columns = ["block", "part", "counts", "word", *_SUMS]
    return pd.concat([x.reindex(columns=columns).astype(whole) for x in (answers, words)])


class WordSums:
    """What Kneser-Ney needs of words, as arrays by model and number: bounded by the vocabulary."""

    def __init__(self, sums: pd.DataFrame, sizes: list[int]):
        """``sums`` has ``word`` and ``_SUMS``; ``sizes`` are those of the vocabularies of the models."""
        words = sums[sums["word"] >= 0]
        self.total, one, two, more, self.leaders = (np.zeros(len(sizes) << 16, np.int64) for _ in _SUMS)
        for array, name in zip((self.total, one, two, more, self.leaders), _SUMS):
            array[words["word"]] = words[name]
        counts = sums[sums["word"] < 0].set_index("word")
        self.pairs, self.pair, self.single, self.left = (np.zeros((len(sizes), k)) for k in (1, 4, 4, 1))
        # One event for each token that can follow: all but the begin.
        self.uniform = 1 / (np.array(sizes, float) + FIRST - 1)
        self.weight = np.zeros(len(sizes) << 16)
        for m in range(len(sizes)):
            own = slice(m << 16, (m + 1) << 16)
            leaders = self.leaders[own]
            n = [int(counts.at[-1 - m, k]) for k in _SUMS[1:]] if -1 - m in counts.index else [0] * 4
            self.pair[m, 1:], self.single[m, 1:] = _discounts_of(n), _discounts(leaders)
            self.pairs[m] = leaders.sum()
            d = self.pair[m]
            lost = d[1] * one[own] + d[2] * two[own] + d[3] * more[own]
            self.weight[own] = np.minimum(lost / np.maximum(self.total[own], 1), 1)
            self.left[m] = min(self.single[m][np.minimum(leaders, 3)].sum() / max(leaders.sum(), 1), 1)


def log_probabilities(p: Pairs, counts: np.ndarray, sums: WordSums) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the log probabilities of each document's tokens, after their leaders and alone.

    ``counts`` are the corpus's of ``p.keys``.
    """
    docs, key = len(p.meta), p.keys[p.at]
    model, leader, follower = key >> 32, key >> 16, (key >> 32) << 16 | key & 0xFFFF
    c = np.maximum(counts[p.at] - p.n, 0)

    def by_word(word: np.ndarray, value: np.ndarray) -> np.ndarray:
        _, at = np.unique(p.doc << 22 | word, return_inverse=True)
        return np.bincount(at, value)[at] if len(at) else value

    alone = (c == 0).astype(float)
    total = sums.total[leader] - by_word(leader, p.n)
    leaders = np.maximum(sums.leaders[follower] - by_word(follower, alone), 0)
    pairs = sums.pairs[model, 0] - np.bincount(p.doc, alone, docs)[p.doc]
    low = np.maximum(leaders - sums.single[model, np.minimum(leaders, 3).astype(int)], 0) / np.maximum(pairs, 1)
    low = np.where(pairs > 0, low + sums.left[model, 0] * sums.uniform[model], sums.uniform[model])
    high = np.maximum(c - sums.pair[model, np.minimum(c, 3)], 0) / np.maximum(total, 1) + sums.weight[leader] * low
    led = np.log(np.minimum(np.where(total > 0, high, low), 1))
    return np.bincount(p.doc, p.n * led, docs), np.bincount(p.doc, p.n * np.log(np.minimum(low, 1)), docs)


def score_words(documents: DataFrame, models: dict[str, Model]) -> DataFrame:
    """Base figures, ``digest`` and ``log_ppl`` of a token under the model of the row's language, a row for each document.

    ``models`` are those of spelling and vocabulary; pairs are counted over ``documents``.
    """
    spark = documents.sparkSession
    shared, names = spark.sparkContext.broadcast(models), sorted(models)
    size = documents.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    parts = -(-size // PART) or 1
    # Blocks have random names: they are written once, and read by both sides.
    blocks = materialise(documents.select("doc_id", "lang", "text").mapInPandas(_encoder(shared, names), "block long, meta binary, tokens binary"))
    schema = "block long, part int, counts binary, word long, " + ", ".join(f"{c} long" for c in _SUMS)
    sent = blocks.mapInPandas(_sender(parts), "block long, part int, keys binary, counts binary")
    answered = materialise(sent.groupBy("part").applyInPandas(_corpus_counts, schema))
    sums = answered.where("word IS NOT NULL").groupBy("word").agg(*(F.sum(c).alias(c) for c in _SUMS)).toPandas().fillna(0).astype(np.int64)
    ready = spark.sparkContext.broadcast(WordSums(sums, [len(models[n].words) for n in names]))

    def judged(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        p = pairs_of(left["meta"].iloc[0], left["tokens"].iloc[0], parts)
        back = right.sort_values("part")["counts"]
        counts = np.concatenate([np.empty(0, np.int64), *map(_unpack, back)])
        if len(counts) != len(p.keys):
            raise ValueError("a block got back other pairs than it sent")
        out = p.meta
        spelled = out["spelled"].to_numpy().view(np.float64)
        steps = np.maximum(out["tokens"] - 1, 1)
        led, alone = log_probabilities(p, counts, ready.value)
        out["log_ppl"] = (-(led + spelled) / steps).where(out["tokens"] > 0)
        out["order_gain"] = ((led - alone) / steps).where(out["tokens"] > 0)
        out["doc_id"] = out["doc_id"].astype("Int64").mask(out["no_id"] == 1)
        out["model"] = [names[i] if i >= 0 else OTHER for i in out["model"]]
        return out[_COLUMNS]

    answers = answered.where("block IS NOT NULL").select("block", "part", "counts")
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(judged, _FIGURES)


_FIGURES = "doc_id long, model string, digest long, log_ppl double, order_gain double, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_COLUMNS = ["doc_id", "model", "digest", "log_ppl", "order_gain", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judge(documents: DataFrame) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, log_ppl,
    band_low, band_high)``, one row for each row of ``documents``.

    Null and empty texts have no words and fail the base. Bands are quartiles over the distinct texts of a language
    that pass the base; without any, nothing more is rejected. A row without a doc_id is judged like any other.
    """
    documents = in_small_batches(documents).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    ppl = F.when(F.isnan("log_ppl"), None).otherwise(F.col("log_ppl"))
    scored = materialise(score_words(documents, fit(documents)).withColumn("log_ppl", ppl).withColumn("base_failed", failed))
    figures = ("log_ppl", "order_gain")
    distinct = scored.where("NOT base_failed").groupBy("model", "digest").agg(*(F.max(c).alias(c) for c in figures))
    q = distinct.groupBy("model").agg(*(F.percentile_approx(c, [0.25, 0.5, 0.75], 10000).alias(c) for c in figures))

    def span(figure: str, width: float, upper: bool = False):
        a, b = (F.col(figure)[i + upper] for i in (0, 1))
        return F.greatest(width * (b - a), F.lit(BAND_LEAST))

    bands = q.select(
        "model",
        (F.col("log_ppl")[0] - span("log_ppl", LOW_WIDTH)).alias("band_low"),
        (F.col("log_ppl")[2] + span("log_ppl", HIGH_WIDTH, True)).alias("_high"),
        (F.col("order_gain")[0] - span("order_gain", GAIN_WIDTH)).alias("_gain"),
    )
    high = F.when(F.col("log_ppl").isNull(), F.col("_high")).otherwise(F.least("_high", F.col("log_ppl") + F.col("order_gain") - F.col("_gain")))
    inside = F.coalesce(F.col("log_ppl").between(F.col("band_low"), F.col("band_high")), F.lit(True))
    # One row for each model, LANGUAGES + 1 at most.
    return scored.join(F.broadcast(bands), "model", "left").withColumn("band_high", high).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & inside).alias("kept"), "log_ppl", "band_low", "band_high", "order_gain",
    )
