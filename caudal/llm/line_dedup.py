"""Repeated passages by hashing the sentences of lines.

A unit is a sentence of a line: text up to a full stop, question or exclamation mark with white space
after it, up to a full-width mark, or the end of the line. Units are normalised (A-Z lower-cased, white space to one space) and
digested to 128 bits. Digests are grouped over all documents; the occurrence with the smallest
``(doc_id, start)`` ranks first and stays. Every other one goes if it stands in a passage: a run of
neighbouring repeated units of ``PASSAGE`` words or more, where ``LETTERS`` letters of a script that sets no
blanks between words count as one word. A short sentence that comes up in two
documents by chance is no passage and stays where it is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.text import in_small_batches
from caudal.operators.skew import lookup_side

PASSAGE, LETTERS = 25, 2
_UNIT = re.compile(r"[^\n]*?(?:[.!?](?=[\x20\x09\x0B-\x0D])|[。！？．｡]+[」』”’）]*|(?=\n)|\Z)[\x20\x09\x0B-\x0D]*")
# Thai, Lao, Burmese, Khmer, Chinese, Japanese and full-width marks.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3000-\u30ff\u3400-\u9fff\uf900-\ufaff\uff00-\uffef\U00020000-\U0003ffff]")


def units(text: str) -> list[tuple[int, int]]:
    """Start and end of each unit; with the line ends between them they cover ``text``."""
    return [m.span() for m in _UNIT.finditer(text) if m.end() > m.start()]


def normalised(unit: str) -> bytes:
    return b" ".join(unit.encode("utf-8", "replace").lower().split())


def size_of(unit: str) -> float:
    """Words of a unit; ``LETTERS`` letters that stand without blanks are one."""
    if unit.isascii():
        return len(normalised(unit).split())
    rest, letters = _UNSPACED.subn(" ", unit)
    return len(normalised(rest).split()) + letters / LETTERS


def _unit_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for rank, mark, text in zip(batch["_rank"], batch["_mark"], batch["text"]):
            for start, end in units(text):
                norm = normalised(text[start:end])
                if norm:
                    digest = xxhash.xxh3_128_intdigest(norm)
                    out.append((digest >> 64, digest & 0xFFFFFFFFFFFFFFFF, rank, (mark << 32) | start))
        if out:
            high, low, ranks, places = zip(*out)
            yield pd.DataFrame(
                {
                    "h1": np.array(high, np.uint64).view(np.int64),
                    "h2": np.array(low, np.uint64).view(np.int64),
                    "_rank": np.array(ranks, np.int64),
                    "place": np.array(places, np.int64),
                }
            )


def _passages(text: str, repeated: set[int], passage: int) -> list[tuple[int, int]]:
    """Spans of runs of repeated units with ``passage`` words or more. Units without a word join runs."""
    out, open_at, end_at, n = [], None, 0, 0
    for start, end in [*units(text), (len(text), len(text))]:
        size = size_of(text[start:end])
        if start in repeated and size:
            open_at = start if open_at is None else open_at
            end_at, n = end, n + size
        elif size or start == len(text):
            if open_at is not None and n >= passage:
                out.append((open_at, end_at))
            open_at, n = None, 0
    return out


def _ranked(documents: DataFrame) -> DataFrame:
    """``documents`` with ``_rank``, the doc_id with null last, and ``_mark``, which tells apart texts that share one."""
    rank = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    mark = F.xxhash64(F.col("text").cast("string")).bitwiseAND(F.lit((1 << 31) - 1))
    return in_small_batches(documents).withColumns({"_rank": rank, "_mark": mark})


def repeated_units(ranked: DataFrame) -> DataFrame:
    """``(_rank, _mark, _starts)``: where the units stand that an earlier occurrence repeats."""
    rows = ranked.select("_rank", "_mark", F.col("text").cast("string").alias("text")).where("text != ''")
    found = rows.mapInPandas(_unit_rows, "h1 long, h2 long, _rank long, place long")
    at = F.struct("_rank", "place")
    first = found.groupBy("h1", "h2").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = found.join(lookup_side(first), ["h1", "h2"]).where(at != F.col("first"))
    start = F.col("place").bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
    return later.groupBy("_rank", F.shiftright("place", 32).alias("_mark")).agg(F.collect_set(start).alias("_starts"))


def without_passages(documents: DataFrame, passage: int = PASSAGE) -> DataFrame:
    """``documents`` with ``_kept``, the text that stays, and ``_spans``, the removed ``(start, end)`` code points
    of the original in order; both null where nothing goes.

    The earliest occurrence is the one with the smallest doc_id; rows without one rank last. Rows equal in
    doc_id and text are one document: each keeps what the document keeps. Texts are shuffled once.
    """

    @F.pandas_udf("kept string, spans array<struct<start: int, end: int>>")
    def cut(texts: pd.Series, starts: pd.Series) -> pd.DataFrame:
        out = []
        for text, own in zip(texts, starts):
            spans = [] if text is None or own is None else _passages(text, {int(x) for x in own}, passage)
            if not spans:
                out.append((None, None))
                continue
            edges = [0, *(x for s in spans for x in s), len(text)]
            kept = "".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
            out.append((kept, [{"start": a, "end": b} for a, b in spans]))
        return pd.DataFrame(out, columns=["kept", "spans"], dtype=object)

    ranked = _ranked(documents)
    joined = ranked.join(repeated_units(ranked), ["_rank", "_mark"], "left")
    lost = cut(F.when(F.col("_starts").isNotNull(), F.col("text").cast("string")), F.col("_starts"))
    cut_off = joined.withColumn("_lost", lost)
    return cut_off.withColumns({"_kept": F.col("_lost.kept"), "_spans": F.col("_lost.spans")}).drop("_rank", "_mark", "_starts", "_lost")


def deduplicated(documents: DataFrame, passage: int = PASSAGE) -> DataFrame:
    """``(doc_id, n_chars, n_removed, spans, text)``, one row for each row of ``documents``.

    ``text`` is what stays, ``spans`` the removed code points of the original, ``n_chars`` the length of
    what stays. A null text stays null, with no spans.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = without_passages(rows, passage)
    whole, kept = F.coalesce(F.length("text"), F.lit(0)).cast("long"), F.length("_kept").cast("long")
    return found.select(
        "doc_id",
        F.coalesce(kept, whole).alias("n_chars"),
        F.coalesce(whole - kept, F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("_spans", F.array().cast("array<struct<start: int, end: int>>")).alias("spans"),
        F.coalesce("_kept", "text").alias("text"),
    )


def drop_repeats(documents: DataFrame, passage: int = PASSAGE) -> DataFrame:
    """``documents`` with repeated passages cut from ``text``, and ``n_chars`` made to fit if it is there.

    A document that loses all its words goes; one that had none before stays.
    """
    found = without_passages(documents, passage)
    found = found.where(F.col("_kept").isNull() | F.col("_kept").rlike(r"[^\x20\x09-\x0D]"))
    new = {"text": F.coalesce("_kept", "text")}
    if "n_chars" in documents.columns:
        new["n_chars"] = F.coalesce(F.length("_kept").cast("long"), "n_chars")
    return found.withColumns(new).select(*documents.columns)
