"""Mixing sources to target weights.

The words of a source, document after document, are packed into blocks of ``BLOCK`` words. A source
gives whole passes over its blocks and then a part of one more, up to its target to the word. Its
slots fall on output shards by a multinomial draw; a slot finds its block through a pseudorandom
permutation of the source's block numbers, a new one for each pass, and blocks are joined by number.

Order within a source comes from a running sum in two levels: documents within a bucket, buckets
within a source, with as many buckets as the square root of the row count. A source that holds a third
of all rows so never meets in one task.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caudal.llm.text import WORD, WORD_SQL, in_small_batches, mix
from caudal.operators.ranking import with_row_number
from caudal.session import materialise

WEIGHTS = (5, 2, 1)
SHARE, CAP = 1.5, 2
BLOCK = 64
SHARD_SLOTS = 16384
SEED = 20240229


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.expr(f"regexp_count(`{text}`, '{WORD_SQL}')"), F.lit(0)).cast("long")


def permuted(i: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of ``0 .. n - 1``: four Feistel rounds, repeated until within range."""
    half = max(1, math.ceil(math.log2(max(n, 2)) / 2))
    mask = np.uint64((1 << half) - 1)
    shift = np.uint64(half)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & mask
        for k in range(4):
            salt = np.uint64((key * 4 + k + 1) & 0xFFFFFFFFFFFFFFFF)
            left, right = right, left ^ (mix(right + mix(np.full(1, salt))) & mask)
        return (left << shift) | right

    out = once(i.astype(np.uint64))
    while (far := out >= n).any():
        out[far] = once(out[far])
    return out.astype(np.int64)


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``(sid, source, source_size, n_documents, weight, target)`` by source.

    Sources by code point, null last, take the weights in turn. Targets share ``share`` of all words by
    weight; one above ``cap`` times its source's words stops there and its excess is shared again by
    weight. Each round of that is one aggregate over the source table.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_documents"))
    by = by.withColumn("_null", F.col("source").isNull())
    ranked = with_row_number(by, ["_null", "source"], "sid").drop("_null")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(F.col("sid") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = materialise(ranked.withColumn("weight", weight))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while True:
        full = F.col("weight") * level >= cap * F.col("source_size")
        held, free, n = ranked.agg(
            F.coalesce(F.sum(F.when(full, cap * F.col("source_size"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
            F.count_if(full),
        ).first()
        if n == stopped or not free:
            break
        stopped, level = n, (share * total - float(held)) / free
    target = F.least(F.col("weight") * level, cap * F.col("source_size").cast("double")) if free else cap * F.col("source_size").cast("double")
    return ranked.withColumn("target", target)


def layout(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Every row of ``sizes`` with its source's ``sid`` and figures, and ``start``: words before it there."""
    n = sizes.count()
    buckets = max(1, math.isqrt(n))
    numbered = sizes.withColumnRenamed("source", "_source").join(
        sources.select("sid", "source", "source_size", "target"), F.col("_source").eqNullSafe(F.col("source"))
    ).drop("_source")
    numbered = numbered.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size"), F.lit(buckets)))
    within = Window.partitionBy("sid", "bucket").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        numbered.groupBy("sid", "bucket").agg(F.sum("size").alias("_n"))
        .withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select("sid", "bucket", "_base")
    )
    placed = numbered.withColumn("_in", F.coalesce(F.sum("size").over(within), F.lit(0))).join(starts, ["sid", "bucket"])
    return materialise(placed.withColumn("start", F.col("_base") + F.col("_in")).drop("_in", "_base", "bucket"))


def slots(sources: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """``(sid, block, taken, pass, shard, place)``: the blocks of the mix, ``taken`` words of each.

    Every source's slots are dealt over the shards by a multinomial draw with equal chances, so a shard
    holds sources in proportion to their targets but for chance, and a source's total is exact.
    """
    blocks = F.ceil(F.col("source_size") / block)
    need = F.least(F.round("target").cast("long"), 2 * F.col("source_size"))
    plan = (
        sources.where("source_size > 0")
        .select("sid", "source_size", blocks.alias("blocks"), need.alias("need"))
        .withColumn("full", F.expr("need DIV source_size"))
        .withColumn("rest", F.expr("need % source_size"))
        .withColumn("n", F.col("full") * F.col("blocks") + F.ceil(F.col("rest") / block))
    )
    total = plan.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-int(total) // shard_slots))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                drawn = np.random.default_rng([seed, int(row.sid)]).multinomial(int(row.n), np.full(shards, 1 / shards))
                shard = np.flatnonzero(drawn)
                count = drawn[shard]
                yield pd.DataFrame(
                    {"sid": row.sid, "source_size": row.source_size, "blocks": row.blocks, "full": row.full, "rest": row.rest,
                     "shard": shard, "base": np.cumsum(count) - count, "held": count}
                )

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                for low in range(0, int(row.held), 1 << 20):
                    j = np.arange(row.base + low, row.base + min(row.held, low + (1 << 20)))
                    times, i = np.divmod(j, row.blocks)
                    chosen = np.empty(len(j), np.int64)
                    for t in np.unique(times):
                        own = times == t
                        chosen[own] = permuted(i[own], int(row.blocks), seed + 1_000_003 * int(row.sid) + int(t))
                    taken = np.minimum(block, row.source_size - chosen * block)
                    part = times == row.full  # the last pass stops at the target
                    taken[part] = np.minimum(taken[part], row.rest - i[part] * block)
                    place = mix((np.uint64(row.sid) << np.uint64(40)) + j.astype(np.uint64)).view(np.int64)
                    yield pd.DataFrame(
                        {"sid": row.sid, "block": chosen, "taken": taken, "pass": times, "shard": row.shard, "place": place}
                    )

    dealt = plan.drop("need").repartition("sid").mapInPandas(
        deal, "sid long, source_size long, blocks long, full long, rest long, shard long, base long, held long"
    )
    spread = dealt.repartition(int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions")), "sid", "shard")
    # Written out, so that joins know its size: a plan would guess it from the few ranges it comes from.
    return materialise(spread.mapInPandas(fill, "sid long, block long, taken long, pass long, shard long, place long"))


def pieces(placed: DataFrame, chosen: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(sid, start, pass, shard, place, low, high)``: the words of each document that each slot takes,
    counted from the document's first. ``start`` and ``sid`` name the document."""
    spans = placed.where("size > 0").select("sid", "start", "size").withColumn(
        "block", F.explode(F.sequence(F.expr(f"start DIV {block}"), F.expr(f"(start + size - 1) DIV {block}")))
    )
    # A document explodes into many spans: sizes before that say nothing, so no side is broadcast.
    met = chosen.join(spans.hint("merge"), ["sid", "block"])
    at = F.col("block") * block
    low = F.greatest(at, F.col("start")) - F.col("start")
    high = F.least(at + F.col("taken"), F.col("start") + F.col("size")) - F.col("start")
    met = met.select("sid", "start", "pass", "shard", "place", low.alias("low"), high.alias("high"))
    return met.where("high > low")


def _sized(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count().alias("size")
    )


def mixed_counts(documents: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)``, one row for each row of ``documents``.

    A null text has no words and nothing is taken of it; a null source is a source of its own, the last.
    Rows that repeat a doc_id are documents of their own. No documents give no rows.
    """
    sizes = materialise(_sized(documents))
    sources = source_targets(sizes)
    placed = layout(sizes, sources)
    took = pieces(placed, slots(sources, block), block).groupBy("sid", "start").agg(F.sum(F.col("high") - F.col("low")).alias("_took"))
    took = took.select(F.col("sid").alias("_sid"), F.col("start").alias("_start"), "_took")
    same = (F.col("sid") == F.col("_sid")) & (F.col("start") == F.col("_start")) & (F.col("size") > 0)
    return placed.join(took, same, "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("_took", F.lit(0)).cast("long").alias("taken")
    )


_WORD = re.compile(WORD)


def mix_documents(documents: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix as documents with the columns of ``documents``: a row for each pass over a document.

    A row's text is what that pass takes of the document: whole, or its chosen runs of words in order,
    a line each. ``n_chars`` is made to fit if it is there. Documents without words stay as they are, once.
    """
    rows = materialise(in_small_batches(documents).withColumn("_row", F.monotonically_increasing_id()))
    sizes = materialise(rows.select(F.col("_row").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count().alias("size")))
    sources = source_targets(sizes)
    placed = layout(sizes, sources)
    runs = pieces(placed, slots(sources, block), block).groupBy("sid", "start", "pass").agg(
        F.collect_list(F.struct("low", "high")).alias("_runs")
    )
    named = placed.select("sid", "start", F.col("doc_id").alias("_row"), F.col("size").alias("_size"))
    held = F.aggregate("_runs", F.lit(0).cast("long"), lambda n, r: n + r.high - r.low)
    taken = named.where("_size > 0").join(runs, ["sid", "start"]).select("_row", "_runs", (held < F.col("_size")).alias("_part"))
    joined = rows.join(taken, "_row", "left").where("_part IS NOT NULL OR text IS NULL OR NOT text RLIKE '[^\\\\x20\\\\x09-\\\\x0D]'")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, parts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else _cut(t, r) for t, r in zip(texts, parts)], dtype=object)

    # Whole passes stay where they are; only texts to be cut go to Python.
    text = F.col("text").cast("string")
    short = cut(F.when(F.col("_part"), text), F.when(F.col("_part"), F.col("_runs")))
    mixed = joined.withColumn("_cut", short).withColumn("text", F.when(F.col("_part"), F.col("_cut")).otherwise(text))
    if "n_chars" in documents.columns:
        mixed = mixed.withColumn("n_chars", F.length("text").cast("long"))
    return mixed.select(*documents.columns)


def _cut(text: str, runs) -> str:
    spans = sorted((int(r["low"]), int(r["high"])) for r in runs)
    merged = [list(spans[0])]
    for low, high in spans[1:]:
        if low <= merged[-1][1]:
            merged[-1][1] = max(high, merged[-1][1])
        else:
            merged.append([low, high])
    at = [m.span() for m in _WORD.finditer(text)]
    if merged == [[0, len(at)]]:
        return text
    return "\n".join(text[at[low][0] : at[high - 1][1]] for low, high in merged)
