"""Ranked lexical search that groups each item's documents by the terms they hold.

Items are a stated set of queries, dealt in blocks of bounded size. For a block, one pass over the documents builds
segments: for each stretch of documents their lengths and the postings of the block's terms. From the
segments come the corpus counts ``N``, ``L`` and ``df``, added up by Spark, and with them the weights.

A second pass searches segment by segment. For an item, the bitmaps of its terms, a bit to a document,
are laid side by side, so that each document gets a mask of the terms it holds; documents of equal mask
are a group. The best score a group can reach is the sum of its terms' highest contributions in the segment.
Groups are evaluated exactly in falling order of that sum until the ``k``-th best score found is above it: no later
group can hold a better document, or one that ties. A segment gives at most ``k`` rows an item, and a window keeps the best.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caudal.llm.text import blank_pieces, in_small_batches
from caudal.session import materialise

TOP = 10
# Documents and postings of a segment; a document is never cut.
SEGMENT_DOCS, SEGMENT_POSTINGS = 16384, 4 << 20
# Bytes of item text searched at a time.
BLOCK_BYTES = 8 << 20
# Bits of the masks made at a time.
MASK_BITS = 1 << 27
# Documents scored between two looks at the bound.
EVALUATED = 256

SEGMENT = "postings long, ids binary, lost binary, lengths binary, bounds binary, rows binary, counts binary, holding long, terms long"

_LETTERS = bytes.maketrans(bytes(range(128)), bytes(ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(128)))


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The text's terms in order, a few megabytes at a time: runs of ASCII letters and digits, A-Z lower-cased,
    and of all characters beyond ASCII."""
    for piece in blank_pieces((text or "").encode("utf-8", "replace").translate(_LETTERS)):
        yield piece.split()


class _Segment:
    """Documents gathered for a segment, and the postings of the terms asked for."""

    def __init__(self, known: dict[bytes, int]):
        self.known = known
        self.clear()

    def clear(self) -> None:
        self.ids, self.lost, self.lengths, self.postings, self.size = [], [], [], [], 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        found, length, get = [], 0, self.known.get
        for part in terms(text):
            length += len(part)
            own = [t for t in map(get, part) if t is not None]
            if own:
                found.append(np.array(own, np.int32))
        if length:
            which, times = np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.int32), np.empty(0, np.int64))
            self.postings.append((which, np.full(len(which), len(self.ids), np.int32), times))
            self.size += len(which)
            self.ids.append(0 if doc_id is None else doc_id)
            self.lost.append(doc_id is None)
            self.lengths.append(length)

    def full(self) -> bool:
        return len(self.ids) >= SEGMENT_DOCS or self.size >= SEGMENT_POSTINGS

    def packed(self) -> dict:
        which, rows, times = (np.concatenate(c) for c in zip(*self.postings))
        order = np.argsort(which, kind="stable")
        out = {
            "ids": np.array(self.ids, np.int64),
            "lost": np.array(self.lost, np.uint8),
            "lengths": np.array(self.lengths, np.int64),
            "bounds": np.searchsorted(which[order], np.arange(len(self.known) + 1)).astype(np.int64),
            "rows": rows[order],
            "counts": times[order].astype(np.int64 if times.max(initial=0) > 65535 else np.uint16),
        }
        row = {"postings": len(out["counts"]), **{k: v.tobytes() for k, v in out.items()}, "holding": len(self.ids), "terms": int(out["lengths"].sum())}
        self.clear()
        return row


def _segments(known: dict[bytes, int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = _Segment(known)
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].astype("Int64"), batch["text"]):
                held.add(None if doc_id is pd.NA else int(doc_id), text)
                if held.full():
                    yield pd.DataFrame([held.packed()])
        if held.ids:
            yield pd.DataFrame([held.packed()])

    return run


def _document_counts(n_terms: int):
    """How many documents of a task hold each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            for bounds in batch.column("bounds").to_pylist():
                total += np.diff(np.frombuffer(bounds, np.int64))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], names=["term", "df"])

    return run


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def length_penalty(lengths: np.ndarray, n: int, total: int) -> np.ndarray:
    """``100 - 90 + ((90 * length * n) div total)``; in Python numbers where longs are too short."""
    if 90 * int(lengths.max(initial=0)) * n < 2**63:
        return 10 + (90 * n * lengths) // total
    return (10 + (lengths.astype(object) * (90 * n)) // total).astype(np.int64)


def contribution(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class _Index:
    """A segment's postings with the contribution of each."""

    def __init__(self, row: dict, n: int, total: int):
        read = lambda name, kind: np.frombuffer(row[name], kind)
        self.ids, self.lost, self.bounds, self.rows = read("ids", np.int64), read("lost", np.uint8), read("bounds", np.int64), read("rows", np.int32)
        wide = len(row["counts"]) == 8 * row["postings"]
        tf = read("counts", np.int64 if wide else np.uint16).astype(np.int64)
        self.worth = contribution(tf, length_penalty(read("lengths", np.int64), n, total)[self.rows])

    def masks(self, asked: list[int], low: int, high: int) -> np.ndarray:
        """For each document of a stretch, the bits of the terms it holds, packed into bytes."""
        held = np.zeros((len(asked), high - low), bool)  # a bitmap for each term
        for i, term in enumerate(asked):
            rows = self.rows[self.bounds[term] : self.bounds[term + 1]]
            held[i, rows[np.searchsorted(rows, low) : np.searchsorted(rows, high)] - low] = True
        return np.packbits(held, axis=0, bitorder="little").T

    def scores(self, rows: np.ndarray, asked: list[int], weights: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), np.int64)
        for term, w in zip(asked, weights):
            a, b = self.bounds[term], self.bounds[term + 1]
            at = np.searchsorted(self.rows[a:b], rows)
            at[at == b - a] = 0
            there = self.rows[a:b][at] == rows
            out += np.where(there, int(w) * self.worth[a:b][at], 0)
        return out

    def best(self, asked: list[int], weights: np.ndarray, k: int) -> list[tuple[int, int]]:
        """``(row, score)`` of the item's best documents here, equal scores by id."""
        own = [(t, w) for t, w in zip(asked, weights) if w > 0 and self.bounds[t] < self.bounds[t + 1]]
        if not own:
            return []
        asked, weights = [t for t, _ in own], np.array([w for _, w in own], np.int64)
        highest = np.array([int(w) * int(self.worth[self.bounds[t] : self.bounds[t + 1]].max()) for t, w in own], np.int64)
        top_rows, top_scores = np.empty(0, np.int64), np.empty(0, np.int64)
        step = max(1, MASK_BITS // len(asked))
        for low in range(0, len(self.ids), step):
            masks = self.masks(asked, low, min(low + step, len(self.ids)))
            wide = np.zeros((len(masks), -(-masks.shape[1] // 8) * 8), np.uint8)
            wide[:, : masks.shape[1]] = masks
            keys = wide.view(np.uint64)
            kinds, group = np.unique(keys[:, 0], return_inverse=True) if keys.shape[1] == 1 else np.unique(keys, axis=0, return_inverse=True)
            bits = np.unpackbits(kinds.reshape(len(kinds), -1).view(np.uint8), axis=1, bitorder="little")[:, : len(asked)]
            bound = np.zeros(len(kinds), np.int64)
            for i, most in enumerate(highest):
                bound += bits[:, i] * most
            members = np.argsort(group.ravel(), kind="stable")
            ends = np.cumsum(np.bincount(group.ravel(), minlength=len(kinds)))
            falling = np.argsort(-bound, kind="stable")
            at = 0
            while at < len(falling):
                least = top_scores[-1] if len(top_scores) == k else 1
                if bound[falling[at]] < least:
                    break
                chosen, size = [], 0
                while at < len(falling) and size < EVALUATED and bound[falling[at]] >= least:
                    g = falling[at]
                    chosen.append(members[(ends[g - 1] if g else 0) : ends[g]])
                    size += len(chosen[-1])
                    at += 1
                rows = np.concatenate(chosen) + low
                scores = self.scores(rows, asked, weights)
                rows, scores = np.concatenate([top_rows, rows]), np.concatenate([top_scores, scores])
                order = np.lexsort((self.ids[rows], self.lost[rows], -scores))[:k]
                top_rows, top_scores = rows[order], scores[order]
        return [(int(r), int(s)) for r, s in zip(top_rows, top_scores) if s > 0]


def _answers(items: list[tuple[int | None, list[int]]], weights: np.ndarray, n: int, total: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                index = _Index(row, n, total)
                out = []
                for item_id, asked in items:
                    for r, score in index.best(asked, weights[asked], k):
                        out.append((item_id, None if index.lost[r] else int(index.ids[r]), score))
                columns = list(zip(*out)) or [()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item_id", "doc_id", "score"])

    return run


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items with their distinct terms, in blocks of about ``block_bytes`` of text. Items without terms are left out."""
    held: dict[int | None, dict[bytes, None]] = {}
    size = 0
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).orderBy("item_id")
    last = object()
    for item_id, text in rows.toLocalIterator():
        if size >= block_bytes and item_id != last:
            yield [(i, list(t)) for i, t in held.items() if t]
            held, size = {}, 0
        own = held.setdefault(item_id, {})
        for part in terms(text):
            own.update(dict.fromkeys(part))
        size += len(text or "")
        last = item_id
    yield [(i, list(t)) for i, t in held.items() if t]


def _search(documents: DataFrame, block: list[tuple[int | None, list[bytes]]], k: int) -> DataFrame:
    known: dict[bytes, int] = {}
    items = [(item_id, [known.setdefault(t, len(known)) for t in own]) for item_id, own in block]
    segments = materialise(documents.mapInPandas(_segments(known), SEGMENT))
    n, total = segments.agg(F.coalesce(F.sum("holding"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first()
    df = np.zeros(len(known), np.int64)
    parts = segments.select("bounds").mapInArrow(_document_counts(len(known)), "term int, df long")
    for term, held in parts.groupBy("term").agg(F.sum("df")).toLocalIterator():  # a row a term of the block
        df[term] = held
    weights = np.array([weight(n, int(d)) for d in df], np.int64)
    return segments.mapInArrow(_answers(items, weights, n, total, k), "item_id long, doc_id long, score long")


def search(documents: DataFrame, items: DataFrame, k: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: for each item its ``k`` best documents with a score above 0.

    Null and empty texts have no terms: such documents count for nothing, such items give no row. Rows that share
    an item_id, or have none, are one item with the terms of all. Rows that repeat a doc_id are documents each;
    those without one come after others of equal score. Scores must fit 63 bits. Other columns are left alone.
    """
    docs = in_small_batches(documents).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = [_search(docs, block, k) for block in _blocks(items, block_bytes) if block]
    if not found:
        found = [documents.sparkSession.createDataFrame([], "item_id long, doc_id long, score long")]
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
