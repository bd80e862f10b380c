"""Language of a text by rank-order n-gram profiles.

A profile is the list of the most frequent letter n-grams (one to three letters, word ends included)
by rank. A document takes the language whose profile its own list is least out of place with: each of
its n-grams costs the difference of the two ranks, or the most possible if the profile lacks it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudal.llm.text import in_small_batches
from caudal.session import materialise

PROFILE = 300
# The profiles are fitted on about this many labelled documents of each language, chosen by hash.
TRAIN_DOCUMENTS = 3000
# So many languages are learned at most, those with the most documents: it bounds what tasks receive.
MOST_LANGUAGES = 1000
UNKNOWN = "und"
_BITS = 21
# Characters of a text whose n-grams are counted at a time: bounds memory, not the text.
PIECE = 1 << 18


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of ``text`` as numbers and how often each occurs; none without a letter."""
    empty = np.empty(0, np.int64), np.empty(0, np.int64)
    if not text:
        return empty
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    gram, n = empty
    last = np.ones(1, np.int64)  # what stands before the piece; 1 stands for what is between words
    for low in range(0, len(code), PIECE):
        part = code[low : low + PIECE]
        part = np.where(_letters()[part], part + 2, 1).astype(np.int64)
        if low + PIECE >= len(code):
            part = np.r_[part, 1]
        old = len(last)
        part = np.r_[last, part]
        fresh = (part != 1) | np.r_[True, part[:-1] != 1]
        part, old = part[fresh], int(fresh[:old].sum())
        two = part[:-1] | (part[1:] << _BITS)
        three = two[:-1] | (part[2:] << (2 * _BITS))
        # Only n-grams that end in this piece; earlier ones have been counted.
        one = part[old:]
        found = np.concatenate([one[one != 1], two[max(old - 1, 0) :], three[max(old - 2, 0) :]])
        own, times = np.unique(found, return_counts=True)
        known, at = np.unique(np.concatenate([gram, own]), return_inverse=True)
        gram, n = known, np.bincount(at, np.concatenate([n, times]), len(known)).astype(np.int64)
        last = part[-2:]
    letters = (gram != 1) & (gram < 1 << _BITS)
    return (gram, n) if letters.any() else empty


def ranked(gram: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent n-grams, ties by number."""
    if len(gram) > size:
        least = np.partition(n, len(n) - size)[len(n) - size]
        gram, n = gram[n >= least], n[n >= least]
    return gram[np.lexsort((gram, -n))][:size]


@dataclass
class Profiles:
    """Ranks of every profiled n-gram in every language; ``size`` where a language lacks it."""

    languages: list[str]
    grams: np.ndarray
    ranks: np.ndarray
    size: int

    @classmethod
    def of(cls, lists: dict[str, np.ndarray], size: int) -> Profiles:
        languages = sorted(lists)
        grams = np.unique(np.concatenate([*lists.values(), np.empty(0, np.int64)]))
        ranks = np.full((len(grams), len(languages)), size, np.int32)
        for k, name in enumerate(languages):
            ranks[np.searchsorted(grams, lists[name]), k] = np.arange(len(lists[name]))
        return cls(languages, grams, ranks, size)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and a score from 0 to 1: one less the distance over the largest possible."""
        own = ranked(*ngrams(text), self.size)
        if not len(own) or not self.languages:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        known = self.grams[at] == own
        apart = np.abs(self.ranks[at] - np.arange(len(own))[:, None])
        cost = np.where(known[:, None] & (self.ranks[at] < self.size), apart, self.size).sum(0)
        best = int(cost.argmin())
        return self.languages[best], float(1 - cost[best] / (len(own) * self.size))


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for lang, texts in batch.groupby("lang")["text"]:
            parts = [ngrams(t) for t in texts]
            gram = np.concatenate([p[0] for p in parts])
            n = np.concatenate([p[1] for p in parts])
            known, at = np.unique(gram, return_inverse=True)
            total = np.bincount(at, n, len(known)).astype(np.int64)
            yield pd.DataFrame({"lang": lang, "gram": known, "n": total})


def fit(labelled: DataFrame, documents: int = TRAIN_DOCUMENTS, size: int = PROFILE) -> Profiles:
    """Profiles from the ``lang`` and ``text`` of labelled rows; rows without either teach nothing.

    About ``documents`` rows of each language are read, chosen by a hash of the text, all of a smaller
    one. Counting is a Spark aggregation; what reaches the driver is ``size`` n-grams a language.
    """
    rows = in_small_batches(labelled).where("lang IS NOT NULL AND text IS NOT NULL").select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    )
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES)
    share = F.broadcast(counts.select("lang", (F.lit(float(documents)) / F.col("n")).alias("share")))
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    taken = rows.join(share, "lang").where(draw < F.col("share")).select("lang", "text")
    counted = taken.mapInPandas(_count, "lang string, gram long, n long")
    counted = materialise(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    lists = {}
    for (lang,) in counted.select("lang").distinct().orderBy("lang").collect():
        top = counted.where(F.col("lang") == lang).orderBy(F.desc("n"), "gram").limit(size).select("gram").collect()
        lists[lang] = np.array([r[0] for r in top], np.int64)
    return Profiles.of(lists, size)


def predicted(profiles: Profiles, text: str = "text") -> Column:
    """``struct(lang_pred, score)`` of a text; ``und`` and 0 where it is null or has no letter.

    Only the text goes to Python, and only the answer comes back.
    """

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([profiles.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict(F.col(text).cast("string"))


def is_held_out(doc_id: str = "doc_id") -> Column:
    """True for the fifth of documents that profiles are never fitted on; false without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify(documents: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``, one row for each row of ``documents``.

    Profiles are fitted on rows with an id that is not held out. Repeated rows get equal answers.
    """
    held = is_held_out()
    profiles = fit(documents.where(~held & F.col("doc_id").isNotNull()).select("lang", "text"))
    return documents.select("doc_id", held.alias("held_out"), predicted(profiles).alias("said")).select(
        "doc_id", "held_out", "said.lang_pred", "said.score"
    )


def keep_known(documents: DataFrame, least: float = 0.05) -> DataFrame:
    """``documents`` whose language is found with a score of ``least`` or more; their columns as they were.

    Text without letters goes, and text whose n-grams hardly any profile knows.
    """
    profiles = fit(documents.where(~is_held_out()).select("lang", "text"))
    said = documents.withColumn("_said", predicted(profiles))
    return said.where((F.col("_said.lang_pred") != UNKNOWN) & (F.col("_said.score") >= least)).select(*documents.columns)
