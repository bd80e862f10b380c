"""Quality of documents by naive Bayes support vectors.

A document is the set of n-grams that it holds: runs of one and two words, and runs of one to four word shapes, a
shape being a word's case, its marks at either end and whether it repeats the word before. N-grams are
hashed into a fixed number of buckets. Every indicator is scaled by the log-count ratio of its bucket, counted over
all labelled documents, and the vector brought to unit length. On these a linear hinge-loss model is
fitted by dual coordinate descent, over a bounded sample of labelled documents.

Labelled documents are dealt into folds by hash. Besides the model of all folds there is one for each fold that saw
neither its counts nor its documents; what those say about their own fold turns margins into probabilities.

The labels meet the texts in one join, in whose tasks n-grams are counted and the sample's sets taken. Counts are bounded
by the buckets, sets by the sample. Scoring reads every text where it lies.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudal.llm.text import blank_pieces, in_small_batches, window_hashes
from caudal.operators.skew import lookup_side
from caudal.session import materialise

WORD_BITS, SHAPE_BITS = 18, 16
WORD_RUNS, SHAPE_RUNS = (1, 2), (1, 2, 3, 4)
BUCKETS = (1 << WORD_BITS) + (1 << SHAPE_BITS)
FOLDS = 3
# Labelled documents that the hinge loss is fitted on, at most.
SAMPLE = 6000
SMOOTHING, PENALTY, PASSES, TOLERANCE = 1.0, 1.0, 40, 0.01
# Counts travel in rows of so many buckets.
COUNT_BLOCK = 4096
THRESHOLD = 0.3

# What a task gathers: blocks of counts, sets of the sample's documents, and how many documents it saw.
PARTS = "fold int, label int, block int, documents long, body binary"
PART_COLUMNS = ["fold", "label", "block", "documents", "body"]
SET, NUMBER = -1, -2


def _shape(word: bytes) -> bytes:
    """A word's marks at either end, up to four, around its case: upper, capital, lower, digits, other or no core."""
    left = word.lstrip(_MARKS)
    core = left.rstrip(_MARKS)
    front, back = word[: len(word) - len(left)], left[len(core) :]
    if core.islower():
        kind = b"a"
    elif core[:1].isupper():
        kind = b"A" if len(core) > 1 and core.isupper() else b"Aa"
    else:
        kind = b"0" if core.isdigit() else b"x" if core else b""
    return b"%s\0%s\0%s" % (front[:4], kind, back[:4])


class _Words(dict):
    """Word to its row in ``hashes``: the hash of the word in lower case, and that of its shape."""

    def __init__(self):
        self.hashes = np.empty((1 << 16, 2), np.uint64)

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self)
        if at == len(self.hashes):
            self.hashes = np.concatenate([self.hashes, np.empty_like(self.hashes)])
        lower = word.isalpha() and word.islower()
        self.hashes[at, 0] = xxhash.xxh3_64_intdigest(word if lower else word.lower())
        self.hashes[at, 1] = _LOWER if lower else xxhash.xxh3_64_intdigest(_shape(word))
        return at

    def of(self, parts: list[bytes]) -> np.ndarray:
        """Hashes of the words in turn. The table is emptied when it is large, so its memory stays bounded."""
        if len(self) > 100_000:
            self.clear()
            self.hashes = self.hashes[: 1 << 16]
        at = np.fromiter(map(self.__getitem__, parts), np.int64, len(parts))
        return self.hashes[at]


class Grams:
    """N-gram buckets of texts, one text after the other."""

    def __init__(self):
        self.words = _Words()

    def of(self, text: str | None) -> np.ndarray:
        """Sorted distinct buckets of a whole text, read a few megabytes at a time."""
        kept, found = np.empty((0, 2), np.uint64), np.empty(0, np.int32)
        last, carry = None, max(*WORD_RUNS, *SHAPE_RUNS) - 1
        for piece in blank_pieces((text or "").encode("utf-8", "replace").translate(_BLANKS)):
            parts = piece.split()
            if not parts:
                continue
            pair = self.words.of(parts)
            same = np.r_[pair[0, 0] == last, pair[1:, 0] == pair[:-1, 0]]
            pair[:, 1] ^= same.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            last = pair[-1, 0]
            pair = np.concatenate([kept, pair])
            runs = [window_hashes(pair[:, 0], n) >> np.uint64(64 - WORD_BITS) for n in WORD_RUNS]
            runs += [(window_hashes(pair[:, 1], n) >> np.uint64(64 - SHAPE_BITS)) + np.uint64(1 << WORD_BITS) for n in SHAPE_RUNS]
            found = np.unique(np.concatenate([found, *(r.astype(np.int32) for r in runs)]))
            kept = pair[-carry:]
        return found


_MARKS = string.punctuation.encode()
_LOWER = xxhash.xxh3_64_intdigest(_shape(b"a"))
_BLANKS = bytes.maketrans(b"\t\n\v\f\r", b"     ")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _labelled(labels: DataFrame) -> DataFrame:
    """``(id, label)``, a row for each document that labels may be learnt from. Several labels: what most say, and 0 in a tie."""
    fine = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    id_ = F.col("doc_id").cast("long").alias("id")
    return fine.groupBy(id_).agg((F.avg("quality") > 0.5).cast("int").alias("label"))


def _gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts by fold, label and block of buckets of a task's documents, and the sets of those in the sample."""
    grams, counts, number = Grams(), {}, {}
    for batch in batches:
        sets = []
        for text, label, fold, drawn in zip(batch["text"], batch["label"], batch["fold"], batch["drawn"]):
            own = grams.of(text)
            key = int(fold), int(label)
            counts.setdefault(key, np.zeros(BUCKETS, np.int64))[own] += 1
            number[key] = number.get(key, 0) + 1
            if drawn:
                sets.append((*key, SET, 0, own.tobytes()))
        yield pd.DataFrame(sets, columns=PART_COLUMNS)
    out = []
    for key, total in counts.items():
        out.append((*key, NUMBER, number[key], b""))
        for block in range(0, BUCKETS, COUNT_BLOCK):
            part = total[block : block + COUNT_BLOCK]
            held = np.flatnonzero(part)
            if len(held):
                out.append((*key, block, 0, held.astype(np.uint16).tobytes() + part[held].tobytes()))
    yield pd.DataFrame(out, columns=PART_COLUMNS)


def _added(batch: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(COUNT_BLOCK, np.int64)
    for body in batch["body"]:
        n = len(body) // 10
        total[np.frombuffer(body[: 2 * n], np.uint16)] += np.frombuffer(body[2 * n :], np.int64)
    first = batch.iloc[0]
    return pd.DataFrame([(first.fold, first.label, first.block, 0, total.tobytes())], columns=PART_COLUMNS)


def log_count_ratios(counts: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """``log (p / |p|) / (q / |q|)`` with smoothed counts; ``counts`` has a row for label 0 and one for label 1."""
    smooth = counts + smoothing
    share = np.log(smooth) - np.log(smooth.sum(1, keepdims=True))
    return np.where(counts.sum(0) > 0, share[1] - share[0], 0.0)


def unit(own: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """Values of a document's buckets: ratios, at unit length."""
    values = ratios[own]
    length = np.sqrt(values @ values)
    return values / length if length > 0 else values


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray, size: int, penalty: float = PENALTY, passes: int = PASSES) -> np.ndarray:
    """Weights, and last the intercept, that minimise ``w'w / 2 + penalty * sum(max(0, 1 - y w'x))``.

    The dual has a variable for each row between 0 and the penalty. A pass visits all in random order and
    moves each to its best value, the others held; it ends when no gradient is off by more than a tolerance.
    """
    w, alpha = np.zeros(size + 1), np.zeros(len(rows))
    norms = np.array([v @ v + 1 for v in values])
    draw = np.random.default_rng(1)
    for _ in range(passes):
        worst = 0.0
        for i in draw.permutation(len(rows)):
            own, x, y = rows[i], values[i], signs[i]
            slope = y * (w[own] @ x + w[size]) - 1
            projected = min(slope, 0) if alpha[i] == 0 else max(slope, 0) if alpha[i] == penalty else slope
            if projected:
                worst = max(worst, abs(projected))
                new = min(max(alpha[i] - slope / norms[i], 0.0), penalty)
                step = (new - alpha[i]) * y
                w[own] += step * x
                w[size] += step
                alpha[i] = new
        if worst < TOLERANCE:
            break
    return w


def _fitted(ratios: np.ndarray):
    """One model: fold -1 learns from the whole sample, another from all but its own, whose margins it returns."""

    def one(model: int, sample: pd.DataFrame) -> tuple:
        sample = sample.sort_values(["label", "body"])  # rows come in any order
        ratio = np.frombuffer(ratios[model + 1], np.float64)
        rows = [np.frombuffer(b, np.int32) for b in sample["body"]]
        values = [unit(own, ratio) for own in rows]
        signs = 2 * sample["label"].to_numpy() - 1
        learnt = np.flatnonzero(sample["fold"].to_numpy() != model)
        w = dual_descent([rows[i] for i in learnt], [values[i] for i in learnt], signs[learnt], BUCKETS)
        asked = np.flatnonzero(sample["fold"].to_numpy() == model)
        margins = np.array([w[rows[i]] @ values[i] + w[-1] for i in asked])
        weights = (w[:-1] * ratio).astype(np.float32).tobytes() if model < 0 else b""
        return model, weights, float(w[-1]), margins.tobytes(), signs[asked].astype(np.int64).tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [batch for batch in batches if len(batch)]  # the sample, which is bounded, once for each model of the task
        for model, sample in pd.concat(held).groupby("model") if held else ():
            yield pd.DataFrame([one(int(model), sample)], columns=["model", "weights", "intercept", "margins", "signs"])

    return run


def sigmoid_fit(margins: np.ndarray, signs: np.ndarray) -> tuple[float, float]:
    """``(a, b)`` of ``1 / (1 + exp(-(a m + b)))``, with targets drawn in from 0 and 1, by Newton steps; ``a`` is not negative."""
    n1, n0 = (signs > 0).sum(), (signs < 0).sum()
    goal = np.where(signs > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones(len(margins))])
    loss = lambda t: np.logaddexp(0, t @ x).sum() - goal @ (t @ x)
    ab = np.array([0.0, np.log((n1 + 1) / (n0 + 1))])
    for _ in range(100):
        p = 1 / (1 + np.exp(-(ab @ x)))
        slope = x @ (p - goal)
        if np.abs(slope).max() < 1e-9 * max(1, len(goal)):
            break
        step = np.linalg.solve((x * (p * (1 - p))) @ x.T + 1e-9 * np.eye(2), slope)
        size = 1.0
        while loss(ab - size * step) > loss(ab) and size > 1e-6:
            size /= 2
        ab = ab - size * step
    return (float(ab[0]), float(ab[1])) if ab[0] >= 0 else (0.0, float(np.log((n1 + 1) / (n0 + 1))))


@dataclass(frozen=True)
class Model:
    """Log-count ratios, weights already scaled by them, and how a margin becomes a probability."""

    ratios: np.ndarray
    weights: np.ndarray
    intercept: float
    slope: float
    shift: float

    def probability(self, own: np.ndarray) -> float:
        values = self.ratios[own]
        length = float(np.sqrt(values @ values))
        margin = self.intercept + (float(self.weights[own].sum(dtype=np.float64)) / length if length > 0 else 0.0)
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500))))


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, folds: int = FOLDS) -> Model:
    """Fits the classifier on the labelled documents that are not held out.

    Ratios are counted over all of them; the hinge loss takes the documents with the ``sample`` smallest hashes of
    their ids. Fewer than two labels among them give a model that says the same of every text.
    """
    named = _labelled(labels)
    mixed = F.xxhash64("id", F.lit("sample"))
    drawn = named.select("id").orderBy(mixed, "id").limit(sample).withColumn("drawn", F.lit(True))
    marked = named.join(F.broadcast(drawn), "id", "left")  # at most ``sample`` ids
    fold = F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(folds)).cast("int").alias("fold")
    side = marked.select("id", "label", fold, F.coalesce("drawn", F.lit(False)).alias("drawn"))
    texts = documents.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    texts = texts.where(F.col("id").isNotNull() & ~held_out(F.col("id")))
    # Labels grow with the corpus, so they are never broadcast: one plan at every size.
    met = texts.join(lookup_side(side).hint("merge"), "id").select("text", "label", "fold", "drawn")
    parts = materialise(met.mapInPandas(_gathered, PARTS))

    counts, number = np.zeros((folds, 2, BUCKETS), np.int64), np.zeros((folds, 2), np.int64)
    for f, y, n in parts.where(F.col("block") == NUMBER).groupBy("fold", "label").agg(F.sum("documents")).collect():
        number[f, y] = n
    added = parts.where("block >= 0").groupBy("fold", "label", "block").applyInPandas(_added, PARTS)
    for row in added.toLocalIterator():  # a row for each block of buckets
        own = np.frombuffer(row.body, np.int64)[: BUCKETS - row.block]
        counts[row.fold, row.label, row.block : row.block + len(own)] = own

    n0, n1 = number.sum(0)
    shift = float(np.log((n1 + 1) / (n0 + 1)))
    blank = Model(np.zeros(BUCKETS), np.zeros(BUCKETS, np.float32), 0.0, 0.0, shift)
    if not n0 or not n1:
        return blank
    total = counts.sum(0)
    ratios = [log_count_ratios(total), *(log_count_ratios(total - counts[f]) for f in range(folds))]
    chosen = parts.where(F.col("block") == SET).select("fold", "label", "body")
    models = chosen.withColumn("model", F.explode(F.array(*(F.lit(f) for f in range(-1, folds)))))
    dealt = models.repartitionById(folds + 1, F.col("model") + 1)
    schema = "model int, weights binary, intercept double, margins binary, signs binary"
    fitted = {r.model: r for r in dealt.mapInPandas(_fitted([r.tobytes() for r in ratios]), schema).collect()}
    if -1 not in fitted:
        return blank
    asked = [fitted[f] for f in range(folds) if f in fitted]
    margins = np.concatenate([np.frombuffer(r.margins, np.float64) for r in asked])
    signs = np.concatenate([np.frombuffer(r.signs, np.int64) for r in asked])
    slope, shift = sigmoid_fit(margins, signs)
    return Model(ratios[0], np.frombuffer(fitted[-1].weights, np.float32), fitted[-1].intercept, slope, shift)


def _scores(model):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams, own = Grams(), model.value
        for batch in batches:
            scores = [own.probability(grams.of(t)) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "held_out": batch["held_out"], "score": scores})

    return run


def classify(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row for each row of ``documents``.

    ``score`` is the probability of label 1. Null and empty texts are scored as texts without n-grams. Rows without a doc_id
    are not held out and teach nothing; rows that repeat one are rows each. Labels other than 0 and 1 are
    left out; without labels of both kinds every text has the same score, from their number. Other columns are left alone.
    """
    documents = in_small_batches(documents)
    model = documents.sparkSession.sparkContext.broadcast(fit(documents, labels, sample))  # sized by the buckets
    id_ = F.col("doc_id").cast("long")
    rows = documents.select(id_.alias("doc_id"), held_out(id_).alias("held_out"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInPandas(_scores(model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
