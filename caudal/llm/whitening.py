"""Whitening of embeddings by a pivoted Cholesky factor and one-sided Jacobi rotations.

Components become whole numbers, so that sums over the table are exact and in any order the same. A first
pass adds the vectors up. A second one centres each vector at the nearest whole mean and adds up its outer
product; what the rounding of the mean left over is taken off exactly. Tasks send their sums in digits of 30 bits,
which Spark adds as longs: exact for any size of entry and table, and a matrix of the dimensions
is all that reaches the driver.

The covariance is factored by Cholesky with diagonal pivoting, ``V[p][:, p] = L L'``. Rotations of pairs of
columns of ``L`` make them orthogonal: their squared norms are the eigenvalues, and the columns of unit
length, rows put back in order, the components. ``V`` is never multiplied out or squared again, so small
eigenvalues keep their digits. Both steps run in extended precision where the machine has it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET, MOST_COMPONENTS = 64, 1_000_000, 32
# Directions with less variance than this share of the largest count as having none.
FLAT = 1e-13
DIGIT_BITS = 30
BLOCK_ROWS = 4096
LONG_MAX = 2**63 - 1

SUMS = "i int, j int, digit int, part long"


def whole(flat: np.ndarray, scale: int = SCALE, offset: int = OFFSET) -> np.ndarray:
    """``floor(scale * c) + offset`` as longs; what is beyond their range counts as its end, less room for the offset."""
    value = np.floor(scale * flat.astype(np.float64))
    return np.clip(value, -(2.0**63), 2.0**63 - 2.0**30).astype(np.int64) + offset


def _vectors(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return whole(batch.column("v").flatten().to_numpy(zero_copy_only=False)).reshape(-1, dims)


def _exact_sum(rows: np.ndarray) -> np.ndarray:
    """Column sums as Python numbers."""
    if np.abs(rows.astype(np.float64)).max(initial=0) * len(rows) < 2**62:
        return rows.sum(axis=0).astype(object)
    return rows.astype(object).sum(axis=0)


def _exact_products(rows: np.ndarray) -> np.ndarray:
    """``rows' rows`` without rounding: by floating point while every partial sum is a whole number below 2^53."""
    widest = float(np.abs(rows.astype(np.float64)).max(initial=0))
    if widest * widest * len(rows) < 2**53:
        dense = rows.astype(np.float64)
        return (dense.T @ dense).astype(np.int64).astype(object)
    exact = rows.astype(object)
    return exact.T @ exact


def _digits(table: np.ndarray, row: int | None = None) -> Iterator[tuple[int, int, int, int]]:
    """``(i, j, digit, part)`` of every number: ``part * 2 ** (30 * digit)`` adds up to it."""
    for (i, j), value in np.ndenumerate(table if row is None else table[None]):
        sign, rest, at = (-1 if value < 0 else 1), abs(int(value)), 0
        while rest:
            low = rest & ((1 << DIGIT_BITS) - 1)
            if low:
                yield (i if row is None else row, j, at, sign * low)
            rest >>= DIGIT_BITS
            at += 1


def _sum_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["i", "j", "digit", "part"])


def _count(dims: int):
    """Rows of a task, as row -2, and sums by dimension, as row -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dims, object)
        for batch in batches:
            rows = _vectors(batch, dims)
            n += len(rows)
            total = total + _exact_sum(rows)
        yield _sum_batch([*_digits(np.array([n], object), -2), *_digits(total, -1)])

    return run


def _scatter(centre: np.ndarray):
    dims = len(centre)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims), object)
        for batch in batches:
            rows = _vectors(batch, dims)
            for low in range(0, len(rows), BLOCK_ROWS):
                total = total + _exact_products(_minus(rows[low : low + BLOCK_ROWS], centre))
        yield _sum_batch(list(_digits(total)))

    return run


def _minus(rows: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """``rows - centre`` exactly; as Python numbers where longs are too short."""
    if np.abs(rows.astype(np.float64)).max(initial=0) < 2**61 and all(abs(int(c)) < 2**61 for c in centre):
        return rows - centre.astype(np.int64)
    return rows.astype(object) - centre


def _gathered(parts: DataFrame) -> dict[tuple[int, int], int]:
    """Exact sums by place. There are as many as places in the matrix, times the digits of a number."""
    out: dict[tuple[int, int], int] = {}
    for i, j, digit, part in parts.groupBy("i", "j", "digit").agg(F.sum("part")).toLocalIterator():
        out[i, j] = out.get((i, j), 0) + (part << (DIGIT_BITS * digit))
    return out


def pivoted_cholesky(v: np.ndarray, flat: float = FLAT) -> tuple[np.ndarray, np.ndarray]:
    """``(order, L)`` with ``v[order][:, order] = L L'``; ``L`` is lower trapezoidal, with a column for each
    pivot above ``flat`` times the first."""
    rest = v.astype(np.longdouble).copy()
    dims = len(rest)
    order, columns = np.arange(dims), np.zeros((dims, dims), np.longdouble)
    first = np.longdouble(0)
    for k in range(dims):
        at = k + int(np.argmax(np.diagonal(rest)[k:]))
        pivot = rest[at, at]
        first = first if k else pivot
        if not pivot > 0 or pivot <= flat * first:
            return order, columns[:, :k]
        swap = [k, at], [at, k]
        rest[swap[0]] = rest[swap[1]]
        rest[:, swap[0]] = rest[:, swap[1]]
        columns[swap[0]] = columns[swap[1]]
        order[swap[0]] = order[swap[1]]
        columns[k, k] = np.sqrt(pivot)
        columns[k + 1 :, k] = rest[k + 1 :, k] / columns[k, k]
        rest[k + 1 :, k + 1 :] -= np.outer(columns[k + 1 :, k], columns[k + 1 :, k])
    return order, columns


def _rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of ``n`` columns in rounds of disjoint ones, as in a tournament."""
    seats = list(range(n + n % 2))
    for _ in range(len(seats) - 1):
        half = len(seats) // 2
        met = [(min(a, b), max(a, b)) for a, b in zip(seats[:half], reversed(seats[half:])) if max(a, b) < n]
        yield np.array([a for a, _ in met], int), np.array([b for _, b in met], int)
        seats.insert(1, seats.pop())


def jacobi_columns(columns: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """Rotates pairs of columns until all are orthogonal to working precision; longest first."""
    g = columns.astype(np.longdouble).copy()
    rounds = list(_rounds(g.shape[1])) if g.shape[1] > 1 else []
    tiny = np.finfo(np.longdouble).eps * np.sqrt(np.longdouble(len(g)))
    for _ in range(sweeps):
        turned = False
        for a, b in rounds:
            left, right = g[:, a], g[:, b]
            aa, bb, ab = (left * left).sum(0), (right * right).sum(0), (left * right).sum(0)
            turn = np.abs(ab) > tiny * np.sqrt(aa * bb)
            if not turn.any():
                continue
            turned = True
            a, b, aa, bb, ab = a[turn], b[turn], aa[turn], bb[turn], ab[turn]
            left, right = left[:, turn], right[:, turn]
            zeta = (bb - aa) / (2 * ab)
            tangent = np.where(zeta < 0, -1, 1) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            cosine = 1 / np.sqrt(1 + tangent * tangent)
            sine = cosine * tangent
            g[:, a], g[:, b] = cosine * left - sine * right, sine * left + cosine * right
        if not turned:
            break
    return g[:, np.argsort(-(g * g).sum(0), kind="stable")]


def principal_axes(v: np.ndarray, flat: float = FLAT) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, largest first, and unit eigenvectors as columns, of a covariance matrix."""
    order, factor = pivoted_cholesky(v, flat)
    turned = jacobi_columns(factor)
    squares = (turned * turned).sum(0)
    axes = np.empty_like(turned)
    axes[order] = turned / np.sqrt(squares)
    return squares, axes


@dataclass(frozen=True)
class Whitener:
    """A fitted transform: rows ``n``, exact sums by dimension, components as columns, their eigenvalues and the
    shares of the variance they explain."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    @property
    def dims(self) -> int:
        return len(self.sums)

    def centred(self, rows: np.ndarray) -> np.ndarray:
        """``x - S / n``: the whole part exactly, then the rest."""
        base = np.array([s // self.n for s in self.sums], object)
        rest = np.array([(s - int(b) * self.n) / self.n for s, b in zip(self.sums, base)])
        return _minus(rows, base).astype(np.float64) - rest

    def whitened(self, rows: np.ndarray) -> np.ndarray:
        return self.centred(rows) @ self.axes / np.sqrt(self.values)

    def deviations(self, rows: np.ndarray) -> list[int]:
        """Sum over the dimensions of ``(n x - S) ** 2``, as Python numbers."""
        sums = np.array(self.sums, object)
        rough = self.centred(rows) * self.n
        if max(float(np.abs(rows.astype(np.float64)).max(initial=0)) * self.n, *(abs(float(s)) for s in self.sums)) < 2**62 and (
            (rough * rough).sum(1).max(initial=0) < 2**62
        ):
            apart = rows * np.int64(self.n) - sums.astype(np.int64)
            return (apart * apart).sum(1).tolist()
        apart = rows.astype(object) * self.n - sums
        return (apart * apart).sum(1).tolist()


def usable(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, v)`` of the rows whose vector holds finite numbers alone."""
    vector = F.col("embedding")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embeddings.where(F.coalesce(fine, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), vector.cast("array<double>").alias("v"))


def fit(rows: DataFrame, dims: int, most: int = MOST_COMPONENTS) -> Whitener:
    """Fits the transform on all ``rows`` of ``usable``; sums are exact, so the order of rows does not matter."""
    vectors = rows.select("v")
    first = _gathered(vectors.mapInArrow(_count(dims), SUMS))
    n, sums = first.get((-2, 0), 0), [first.get((-1, d), 0) for d in range(dims)]
    if not n:
        return Whitener(0, tuple(sums), np.zeros((dims, 0)), np.zeros(0), np.zeros(0))
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], object)
    products = _gathered(vectors.mapInArrow(_scatter(centre), SUMS))
    left = [s - n * int(c) for s, c in zip(sums, centre)]
    # n^2 times the covariance, a whole number; the quotient is rounded once.
    exact = [[n * products.get((i, j), 0) - left[i] * left[j] for j in range(dims)] for i in range(dims)]
    v = np.array([[_quotient(x, n * n) for x in line] for line in exact], np.longdouble).reshape(dims, dims)
    trace = _quotient(sum(exact[i][i] for i in range(dims)), n * n)
    values, axes = principal_axes(v)
    kept = slice(0, most)
    return Whitener(n, tuple(sums), axes[:, kept].astype(np.float64), values[kept].astype(np.float64), (values[kept] / trace).astype(np.float64) if trace else np.zeros(0))


def _quotient(a: int, b: int) -> np.longdouble:
    """``a / b`` in extended precision."""
    shift = max(0, 66 + b.bit_length() - abs(a).bit_length())
    digits = (abs(a) << shift) // b
    spare = max(0, digits.bit_length() - 64)
    value = np.ldexp(np.longdouble(np.uint64(digits >> spare)), spare - shift)
    return -value if a < 0 else value


def _moments(model: Whitener):
    """Of a task's whitened rows: number, mean, and products about that mean."""
    k = model.axes.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, products = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            rows = _vectors(batch, model.dims)
            for low in range(0, len(rows), BLOCK_ROWS):
                w = model.whitened(rows[low : low + BLOCK_ROWS])
                own = w.mean(0)
                apart, step = w - own, own - mean
                products += apart.T @ apart + np.outer(step, step) * (n * len(w) / (n + len(w)))
                mean = mean + step * (len(w) / (n + len(w)))
                n += len(w)
        if n:
            lines = [(i, float(n), (n * mean).tolist(), (products[i] + n * mean[i] * mean).tolist()) for i in range(k)]
            columns = list(zip(*lines))
            kinds = (pa.int32(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["i", "n", "sums", "products"])

    return run


def identity_error(rows: DataFrame, model: Whitener) -> float:
    """Largest absolute entry of the covariance of the whitened rows less the identity."""
    k = model.axes.shape[1]
    if not k:
        return 0.0
    parts = rows.select("v").mapInArrow(_moments(model), "i int, n double, sums array<double>, products array<double>")
    sums = parts.select("i", "n", F.posexplode(F.arrays_zip("sums", "products")).alias("j", "s"))
    totals = sums.groupBy("i", "j").agg(F.sum("n").alias("n"), F.sum("s.sums").alias("s"), F.sum("s.products").alias("p"))
    covariance, mean = np.zeros((k, k)), np.zeros(k)
    for i, j, n, s, p in totals.toLocalIterator():
        covariance[i, j], mean[j] = p / n, s / n
    return float(np.abs(covariance - np.outer(mean, mean) - np.eye(k)).max())


def _transformed(model: Whitener):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _vectors(batch, model.dims)
            for low in range(0, len(rows), BLOCK_ROWS):
                own = rows[low : low + BLOCK_ROWS]
                exact = model.deviations(own)
                white = model.whitened(own)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1) * white.shape[1], pa.int32()), pa.array(white.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").slice(low, len(own)),
                        pa.array([d if d <= LONG_MAX else None for d in exact], pa.int64()),
                        pa.array([str(d) if d > LONG_MAX else None for d in exact], pa.string()),
                        flat,
                    ],
                    names=["vec_id", "deviation", "deviation_text", "white"],
                )

    return run


def whiten(embeddings: DataFrame, most: int = MOST_COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error, deviation_text)``, a row for each
    vector and component.

    Rows whose vector is null or holds a null or non-finite entry take no part, nor do vectors of another length
    than the commonest. Rows without an id, or with a repeated one, count and come back like others. Components
    stop where the table has no more variance: equal vectors, or an empty table, give no rows. An exact
    deviation too large for a long is null, and stands in ``deviation_text``, null elsewhere. Other columns are left alone.
    """
    rows = usable(embeddings)
    common = rows.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n")).where("dims > 0").orderBy(F.desc("n"), "dims").limit(1).collect()
    dims = common[0].dims if common else 1  # of equally common lengths the shortest
    rows = rows.where(F.size("v") == dims)
    model = fit(rows, dims, most)
    error = identity_error(rows, model)
    shares = F.array(*(F.lit(float(x)) for x in model.explained)) if len(model.explained) else F.array().cast("array<double>")
    white = rows.mapInArrow(_transformed(model), "vec_id long, deviation long, deviation_text string, white array<double>")
    lines = white.select("vec_id", "deviation", "deviation_text", F.posexplode("white").alias("at", "whitened"))
    return lines.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
        "deviation_text",
    )
