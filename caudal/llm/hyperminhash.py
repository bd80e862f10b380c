"""Near-duplicate documents by HyperMinHash.

A document's sketch has 252 registers. Each keeps, of the smallest hash that fell into it, the number
of leading zeros and ten bits after them, 16 bits in all. Empty registers borrow from others chosen by
hash, and 42 bands of six registers become bucket keys. Pairs of documents in a bucket are candidates;
the collision-corrected estimate of the Jaccard similarity from whole sketches drops the hopeless
ones with six standard deviations to spare, and the rest are confirmed on full shingle sets.

Two documents at a similarity of 0.85 miss each other in all bands with a chance of 2e-9 (0.8: 3e-6).

Skew. Documents with the same shingle set count as one class, so exact copies never pair up. A bucket
of up to ``SMALL`` classes gives all its pairs, at most ``SMALL`` / 2 per class. A larger one links
its members to one leader first, then to more leaders round by round; after those links are confirmed, members of
the bucket that still lie in different components are compared, so a tight group of any size costs some
comparisons a member and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from operator import add

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.components import components
from caudal.llm.text import WordHashes, in_small_batches, mix, shingle_set, words
from caudal.operators.skew import lookup_side
from caudal.session import materialise

REGISTERS, BAND, MANTISSA = 252, 6, 10
BANDS = REGISTERS // BAND
SMALL = 12
SIGNS = 2048
# Members of a bucket's main component that others meet in the first round; four times as many in each further one.
LEADERS = 24
# A further round follows when one has joined at least this share of the members outside.
WORTHWHILE = 1 / 8
# Documents whose sets leave a task at a time.
SETS_BATCH = 500


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Registers of sorted distinct shingle hashes; zero marks an empty one."""
    out = np.zeros(REGISTERS, np.uint16)
    if not len(shingles):
        return out
    bucket = ((shingles >> np.uint64(32)) * np.uint64(REGISTERS)) >> np.uint64(32)
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    least = np.minimum.reduceat(mix(shingles), first)
    top = least >> np.uint64(11)  # 53 bits, exact as a float
    zeros = 53 - np.frexp(top.astype(np.float64))[1]
    after = np.minimum(zeros + 1, 53).astype(np.uint64)
    bits = (least << after) >> np.uint64(64 - MANTISSA)
    out[bucket[first].astype(np.int64)] = (np.minimum(zeros, 62) << MANTISSA) + bits.astype(np.int64) + 1
    return out


@lru_cache(maxsize=4096)
def _donors(attempt: int) -> np.ndarray:
    here = np.arange(REGISTERS, dtype=np.uint64)
    if attempt >= 8 * REGISTERS:  # every register in turn
        return ((here + np.uint64(attempt)) % np.uint64(REGISTERS)).astype(np.int64)
    return (mix((here << np.uint64(32)) + np.uint64(attempt + 1)) % np.uint64(REGISTERS)).astype(np.int64)


def densify(registers: np.ndarray) -> np.ndarray:
    """Fills the empty registers of each row from others, the same ones for every document."""
    out = registers.copy()
    row, col = np.nonzero((registers == 0) & registers.any(axis=1)[:, None])
    attempt = 0
    while len(row):
        got = registers[row, _donors(attempt)[col]]
        full = got > 0
        out[row[full], col[full]] = got[full]
        row, col = row[~full], col[~full]
        attempt += 1
    return out


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key for each row and band."""
    bands = densify(registers).reshape(len(registers), BANDS, BAND).astype(np.uint64)
    acc = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), bands.shape[:2]).copy()
    for j in range(BAND):
        acc = mix(acc ^ bands[:, :, j])
    return acc.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of paired sketches with accidental agreement taken out, and registers used.

    The chance that two registers agree by accident follows the published approximation, with the
    size of the sketch in place of a power of two.
    """
    used = np.maximum(((a > 0) | (b > 0)).sum(1), 1)
    same = ((a == b) & (a > 0)).sum(1)
    big, little = np.maximum(n_a, n_b), np.maximum(np.minimum(n_a, n_b), 1)
    ratio = big / little
    chance = 0.169919487159739 * 2.0**-MANTISSA * 4 * ratio / (1 + ratio) ** 2
    return np.clip((same / used - chance) / (1 - chance), 0, 1), used


def _sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            shingles = shingle_set(hashes.of(words(text, lower=True)))
            raw = shingles.tobytes()
            digest = xxhash.xxh3_128_digest(raw)
            rows.append((doc_id, len(shingles), digest, sketch(shingles).tobytes()))
        yield pd.DataFrame(rows, columns=["doc_id", "n_shingles", "digest", "sketch"]).astype({"doc_id": "Int64"})


def _shingle_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for batch in batches:
        for low in range(0, len(batch), SETS_BATCH):
            part = batch.iloc[low : low + SETS_BATCH]
            sets = [shingle_set(hashes.of(words(t, lower=True))).view(np.int64) for t in part["text"]]
            yield pd.DataFrame({"id": part["doc_id"], "shingles": sets})


def _registers(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(len(column), REGISTERS)


def _bands(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if len(batch):
            keys = band_keys(_registers(batch["sketch"]))
            yield pd.DataFrame({"key": keys.ravel(), "id": np.repeat(batch["id"].to_numpy(), BANDS)})


def _signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One bit of each of ``SIGNS`` minima of differently mixed shingle hashes, in longs."""
    salts = mix(np.arange(1, SIGNS + 1, dtype=np.uint64))
    for batch in batches:
        rows = []
        for shingles in batch["shingles"]:
            least = np.full(SIGNS, np.uint64(0xFFFFFFFFFFFFFFFF))
            own = np.asarray(shingles, np.int64).view(np.uint64)
            for low in range(0, len(own), 256):
                part = (own[low : low + 256, None] ^ salts) * np.uint64(0x9E3779B97F4A7C15)
                part ^= part >> np.uint64(32)
                least = np.minimum(least, (part * np.uint64(0xD6E8FEB86659FD93)).min(axis=0))
            rows.append(np.packbits((mix(least) & np.uint64(1)).astype(np.uint8), bitorder="little").view(np.int64))
        if rows:
            longs = np.stack(rows)
            yield pd.DataFrame({"id": batch["id"], **{f"s{i}": longs[:, i] for i in range(SIGNS // 64)}})


def _likely(percent: int):
    low = percent / 100

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            n_a, n_b = batch["n_a"].to_numpy(float), batch["n_b"].to_numpy(float)
            j, used = estimate(_registers(batch["s_a"]), _registers(batch["s_b"]), n_a, n_b)
            spare = 6 * np.sqrt(low * (1 - low) / used) + 0.02
            sizes = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
            yield batch.loc[(j >= low - spare) & sizes, ["a", "b"]]

    return keep


class _Confirm:
    """Confirms candidate pairs: first on sketches, then on full sets."""

    def __init__(self, documents: DataFrame, reps: DataFrame, percent: int):
        self.documents, self.reps, self.percent = documents, reps, percent

    def sets(self, ids: DataFrame) -> DataFrame:
        """``(id, shingles)`` of the documents named."""
        # The ids grow with the corpus, so they are never broadcast: one plan at every size.
        texts = self.documents.join(ids.select(F.col("id").alias("doc_id")).hint("merge"), "doc_id", "left_semi")
        return materialise(texts.mapInPandas(_shingle_sets, "id long, shingles array<long>"))

    def __call__(self, pairs: DataFrame, sets: DataFrame | None = None) -> DataFrame:
        side = lambda x: self.reps.select(
            F.col("id").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}")
        )
        likely = pairs.join(side("a"), "a").join(side("b"), "b").mapInPandas(_likely(self.percent), "a long, b long")
        likely = materialise(likely)
        if sets is None:
            sets = self.sets(likely.select(F.col("a").alias("id")).unionByName(likely.select(F.col("b").alias("id"))).distinct())
        one = lambda x: sets.select(F.col("id").alias(x), F.col("shingles").alias(f"set_{x}"))
        met = likely.join(one("a"), "a").join(one("b"), "b")
        both = F.size(F.array_intersect("set_a", "set_b")).cast("long")
        union = F.size("set_a") + F.size("set_b") - both
        return materialise(met.where(100 * both >= self.percent * union).select("a", "b").distinct())


def _merged(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``(key, id, c)`` after ``links`` between components ``(c, o_c)`` have joined these."""
    named = components(links, "c", "o_c").select(F.col("id").alias("c"), "component")
    return materialise(rows.join(lookup_side(named), "c", "left").select("key", "id", F.coalesce("component", "c").alias("c")))


def _left_over(members: DataFrame, labels: DataFrame, confirm: _Confirm) -> DataFrame:
    """Links between large-bucket members that lie in different components so far.

    What is compared in the joins are ``SIGNS`` one-bit minima: at the threshold ``(1 - t) / 2`` of them differ, and
    a pair goes on with up to 4.5 deviations more. First come rounds of leaders: members outside the main
    component of their bucket meet some members of that, drawn by hash, and what links is joined; rounds go on with more
    leaders while they join many. In a tight group most members find a link after as many comparisons as links are rare, whatever the size of the group. Members that are still
    outside are then compared with the rest of their bucket. A pair is compared in the first bucket it shares.
    """
    expected = SIGNS * (1 - confirm.percent / 100) / 2
    limit = int(expected + 4.5 * np.sqrt(expected * (1 - expected / SIGNS))) + 1
    signs = [f"s{i}" for i in range(SIGNS // 64)]
    apart = reduce(add, (F.bit_count(F.col(s).bitwiseXOR(F.col(f"o_{s}"))) for s in signs))

    def placed(rows: DataFrame) -> DataFrame:
        """Members of buckets that have several components, with the main one."""
        held = rows.groupBy("key", "c").agg(F.count(F.lit(1)).alias("n"))
        main = held.groupBy("key").agg(F.max_by("c", F.struct("n", "c")).alias("main"), F.count(F.lit(1)).alias("kinds"))
        return materialise(rows.join(lookup_side(main.where("kinds > 1").drop("kinds")), "key"))

    known = members.join(lookup_side(labels.withColumnRenamed("component", "c")), "id", "left")
    now = placed(materialise(known.select("key", "id", F.coalesce("c", "id").alias("c"))))
    own = now.groupBy("id").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    sets = confirm.sets(own)
    signed = sets.mapInPandas(_signatures, "id long, " + ", ".join(f"{s} long" for s in signs)).join(own, "id")
    signed = materialise(signed)

    def confirmed(met: DataFrame, keys: str) -> DataFrame:
        """Links among the pairs that meet, with the components they join."""
        first = F.array_intersect("keys", keys)[0] == F.col("key")
        near = met.where((F.col("c") != F.col("o_c")) & (apart <= limit) & first)
        swap = F.col("id") > F.col("o_id")
        pair = {"a": F.least("id", "o_id"), "b": F.greatest("id", "o_id"), "c_a": F.when(swap, F.col("o_c")).otherwise(F.col("c")), "c_b": F.when(swap, F.col("c")).otherwise(F.col("o_c"))}
        near = materialise(near.select(*(column.alias(name) for name, column in pair.items())).distinct())
        links = confirm(near.select("a", "b"), sets)
        return links.join(near, ["a", "b"]).select("a", "b", F.col("c_a").alias("c"), F.col("c_b").alias("o_c"))

    found: list[DataFrame] = []
    most, worthwhile = LEADERS, True
    while worthwhile:
        outside = now.where("c != main").select("id").distinct().count()
        sizes = now.select("id", "c").distinct().groupBy("c").agg(F.count(F.lit(1)).alias("size"))
        drawn = F.pmod(F.xxhash64("id", F.lit(most)), F.ceil(F.col("size") / most)) == 0
        lead = now.where("c = main").join(lookup_side(sizes), "c").where(drawn)
        main_keys = lead.groupBy("id").agg(F.min("c").alias("c"), F.collect_set("key").alias("o_keys"))
        lead = main_keys.join(signed.drop("keys"), "id").withColumn("key", F.explode("o_keys"))
        lead = lead.select("key", "o_keys", *(F.col(n).alias(f"o_{n}") for n in ("id", "c", *signs)))
        rest = now.where("c != main").select("key", "id", "c").join(signed, "id")
        links = materialise(confirmed(rest.join(lookup_side(lead), "key"), "o_keys"))
        joined, most = links.count(), most * 4
        worthwhile = joined > 0 and joined >= WORTHWHILE * outside
        if joined:
            found.append(links)
            now = placed(_merged(now, links))
    full = now.join(signed, "id")
    few = full.where("c != main").select("key", *(F.col(n).alias(f"o_{n}") for n in ("id", "c", "keys", *signs)))
    once = (F.col("c") == F.col("main")) | (F.col("id") < F.col("o_id"))
    found.append(confirmed(full.join(few, "key").where(once), "o_keys"))
    return reduce(DataFrame.unionByName, found).select("a", "b")


def near_duplicates(documents: DataFrame, percent: int = 85) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row for each row of ``documents``.

    Links documents whose sets of lower-cased five-word shingles have ``100 * intersection >= percent *
    union``. Null and empty texts have no shingles and no link. Rows with equal sets are linked.
    Rows without a doc_id keep a null component, are kept and link nothing. Rows that repeat a doc_id
    each get a row back and share their links. Other columns are left alone.
    """
    documents = in_small_batches(documents).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_shingles long, digest binary, sketch binary"
    sketched = materialise(documents.mapInPandas(_sketches, schema))
    named = sketched.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = named.groupBy("digest").agg(F.min("doc_id").alias("class_id"))
    rows = materialise(
        sketched.select("doc_id", "n_shingles", "digest")
        .join(lookup_side(classes), "digest", "left")
        .withColumn("class_id", F.when(F.col("n_shingles") > 0, F.col("class_id")))
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"), "digest")
    )
    fewest = int(np.ceil(percent / (100 - percent) - 1e-9)) if percent < 100 else 1 << 60  # smaller sets match equal ones only
    heads = rows.where("doc_id = class_id").select("doc_id", "digest").distinct()
    reps = materialise(
        named.where(F.col("n_shingles") >= fewest)
        .join(heads, ["doc_id", "digest"])
        .groupBy(F.col("doc_id").alias("id"), "digest")
        .agg(F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
    )
    banded = reps.select("id", "sketch").mapInPandas(_bands, "key long, id long")
    # Leaders are least after flipping bits, so that counting buckets needs fixed-width buffers and no sort.
    flip = F.xxhash64(F.pmod("key", F.lit(4)))
    buckets = (
        banded.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.col("id").bitwiseXOR(flip)).alias("lead"))
        .where("n > 1")
        .select("key", "n", F.col("lead").bitwiseXOR(flip).alias("leader"))
    )
    members = materialise(banded.join(lookup_side(buckets), "key"))
    small = members.where(F.col("n") <= SMALL).select("key", "id")
    paired = small.join(small.select("key", F.col("id").alias("b")), "key").where("id < b").select(F.col("id").alias("a"), "b")
    large = members.where(F.col("n") > SMALL)
    star = large.where("id != leader").select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b"))
    confirm = _Confirm(documents, reps, percent)
    links = confirm(paired.unionByName(star).distinct())
    found = components(links, "a", "b")
    if not large.isEmpty():
        more = _left_over(large.select("key", "id"), found, confirm)
        if not more.isEmpty():
            found = components(links.unionByName(more), "a", "b")
    component = F.coalesce("component", "class_id")
    return (
        rows.join(lookup_side(found.withColumnRenamed("id", "class_id")), "class_id", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def drop_near_duplicates(documents: DataFrame, percent: int = 80) -> DataFrame:
    """``documents`` less those whose component has an earlier document; its columns as they were."""
    gone = near_duplicates(documents, percent).where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    return documents.join(gone, F.col("doc_id").cast("long") == F.col("_gone"), "left_anti")
