"""Exact top-k inner products over a bit-sliced index.

A segment holds the vectors of one stretch of the table. Every component is a whole number, kept as
bit slices: one bitmap over the segment's rows for each binary digit, the top one for the sign. The
scores of a query are a bit-sliced sum: the slices of each component, shifted to the digits of the
query's component, are added or subtracted with bitmap arithmetic, a row to a bit. The top rows
are then read off from the most significant slice down; rows of equal score at the boundary go by id.

Segments are built where their rows are read, without a shuffle. Queries are a stated set of rows, sent to
every segment in blocks; a segment answers with at most ``k`` rows a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caudal.session import materialise

SEGMENT_ROWS = 16384
QUERY_BLOCK = 64
SCALE = 1024


def slices_of(values: np.ndarray) -> np.ndarray:
    """Two's complement digits of ``values`` as bitmaps, lowest first and the sign last."""
    width = int(max(values.max(initial=0), -values.min(initial=0) - 1)).bit_length() + 1
    padded = np.zeros(-(-len(values) // 64) * 64, np.int64)
    padded[: len(values)] = values
    digits = (padded >> np.arange(width)[:, None]) & 1
    return np.packbits(digits.astype(np.uint8), axis=1, bitorder="little").view(np.uint64)


def add_shifted(total: list, part: np.ndarray, shift: int, negative: bool) -> None:
    """Adds ``part << shift``, or takes it away, in ``total``: a ripple of full adders over bitmaps.

    Both are two's complement with the sign in the last slice; ``total`` grows when a carry could reach
    its sign.
    """
    while len(total) < len(part) + shift + 2:
        total.append(total[-1])
    carry = np.full(part.shape[1], np.uint64(0xFFFFFFFFFFFFFFFF) if negative else np.uint64(0))
    for i in range(shift, len(total)):
        x = part[min(i - shift, len(part) - 1)]
        if negative:
            x = ~x
        half = total[i] ^ x
        both = total[i] & x
        total[i] = half ^ carry
        carry = both | (half & carry)


def signed_digits(value: int) -> list[tuple[int, bool]]:
    """Powers of two that sum to ``value`` with signs, no two in a row: fewest additions."""
    out, at = [], 0
    while value:
        if value & 1:
            digit = 2 - (value & 3)
            out.append((at, digit < 0))
            value -= digit
        value >>= 1
        at += 1
    return out


def score_slices(index: list[np.ndarray], query: np.ndarray) -> list[np.ndarray]:
    """Bit slices of the inner products of a query with every row of a segment."""
    widest = sum(int(abs(int(q))).bit_length() and 1 for q in query)
    total = [np.zeros(index[0].shape[1], np.uint64)] * (widest.bit_length() + 1)
    for part, q in zip(index, query):
        for shift, negative in signed_digits(int(q)):
            # A spare slice keeps the sign clear of carries from the additions still to come.
            while len(total) < len(part) + shift + 2 + widest.bit_length():
                total.append(total[-1])
            add_shifted(total, part, shift, negative)
    return total


def top_rows(total: list[np.ndarray], alive: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of rows surely among the ``k`` highest scores, and of those that tie for the places left."""
    sure, tied = np.zeros_like(alive), alive.copy()
    for i in range(len(total) - 1, -1, -1):
        ones = ~total[i] if i == len(total) - 1 else total[i]  # a negative score is the lower one
        best = tied & ones
        n = int(np.bitwise_count(sure | best).sum())
        if n > k:
            tied = best
        else:
            sure = sure | best
            tied = tied & ~ones
            if n == k:
                return sure, np.zeros_like(tied)
    return sure, tied


def _rows_of(bitmap: np.ndarray, n: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little")[:n])


def _matrix(blob: bytes, rows: int, dims: int) -> np.ndarray:
    return np.frombuffer(blob, np.int64).reshape(rows, dims)


def _segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of a task in segments by dimension: ids and whole-number components as bytes."""

    def packed(dims: int, ids: list, rows: list) -> dict:
        return {"dims": dims, "ids": np.array(ids, np.int64).tobytes(), "values": np.array(rows, np.int64).tobytes()}

    held: dict[int, tuple[list, list]] = {}
    for batch in batches:
        for vec_id, values in zip(batch["vec_id"], batch["values"]):
            ids, rows = held.setdefault(len(values), ([], []))
            ids.append(vec_id)
            rows.append(values)
            if len(ids) == SEGMENT_ROWS:
                yield pd.DataFrame([packed(len(values), ids, rows)])
                del held[len(values)]
    for dims, (ids, rows) in held.items():
        yield pd.DataFrame([packed(dims, ids, rows)])


def _query_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for dims, part in batch.groupby(batch["values"].map(len)):
            for low in range(0, len(part), QUERY_BLOCK):
                own = part.iloc[low : low + QUERY_BLOCK]
                yield pd.DataFrame(
                    [{"dims": dims, "query_ids": own["vec_id"].to_numpy(np.int64).tobytes(), "query": np.array(list(own["values"]), np.int64).tobytes()}]
                )


def _answer(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, index = None, []
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids = np.frombuffer(row.ids, np.int64)
                values = _matrix(row.values_, len(ids), row.dims)
                if row.segment != last:
                    last, index = row.segment, [slices_of(values[:, d]) for d in range(row.dims)]
                words = -(-len(ids) // 64)
                rows = np.zeros(words * 64, np.uint8)
                rows[: len(ids)] = 1
                everyone = np.packbits(rows, bitorder="little").view(np.uint64)
                out = []
                asked = np.frombuffer(row.query_ids, np.int64)
                for query_id, query in zip(asked, _matrix(row.query, len(asked), row.dims)):
                    alive = everyone.copy()
                    for own in np.flatnonzero(ids == query_id):
                        alive[own // 64] &= ~np.uint64(1 << (own % 64))
                    total = score_slices(index, query) if row.dims else [np.zeros(words, np.uint64)]
                    sure, tied = top_rows(total, alive, k)
                    chosen = _rows_of(sure, len(ids))
                    edge = _rows_of(tied, len(ids))
                    need = k - len(chosen)
                    if need < len(edge):  # equal scores: the smaller ids
                        edge = edge[np.argsort(ids[edge], kind="stable")[:need]]
                    chosen = np.concatenate([chosen, edge])
                    out.append(pd.DataFrame({"query_id": query_id, "vec_id": ids[chosen], "score": values[chosen] @ query}))
                if out:
                    yield pd.concat(out)

    return run


def whole_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, values)``: components as ``floor(scale * x)``. Vectors that are null, or hold a null or
    non-finite component, and rows without an id are left out."""
    vector = F.col("embedding").cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(vector, lambda x: F.floor(x * scale)).alias("values"))


def top_k(embeddings: DataFrame, k: int = 10, every: int = 100, scale: int = SCALE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row whose id ``every`` divides, its ``k`` best other rows.

    Fewer candidates give fewer rows; vectors of different lengths don't meet. Equal scores go to the smaller
    id. Scores must fit 63 bits. Rows that repeat an id are candidates each; as queries
    they answer together, and none meets a row with its own id.
    """
    vectors = whole_vectors(embeddings, scale)
    segments = vectors.mapInPandas(_segments, "dims int, ids binary, values binary")
    segments = materialise(segments.withColumn("segment", F.monotonically_increasing_id()))
    asked = vectors.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "values"])
    blocks = asked.mapInPandas(_query_blocks, "dims int, query_ids binary, query binary")
    number = F.row_number().over(Window.partitionBy("dims").orderBy("segment"))
    numbered = segments.select("dims", "segment").withColumn("seq", number)  # a row for each segment, without its data
    counts = numbered.groupBy("dims").agg(F.max("seq").alias("n"))
    spread = blocks.join(counts, "dims").withColumn("seq", F.explode(F.sequence(F.lit(1), "n"))).drop("n")
    there = segments.withColumnRenamed("values", "values_").join(numbered.select("segment", "seq"), "segment")
    met = there.join(spread, ["dims", "seq"]).select("segment", "dims", "ids", "values_", "query_ids", "query")
    found = met.mapInPandas(_answer(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
