"""Whitening of embeddings by spectrum slicing.

Vectors are taken to whole numbers, so the sums over all distinct vectors, and the covariance made of them, are exact as long as
they fit a double. Tasks add matrices batch by batch and a second stage adds those of the tasks, so the driver gets one matrix
of dimension by dimension. There the signs of the pivots of an LDL' factorisation of the shifted covariance count the
eigenvalues above the shift (inertia); bisection by these counts isolates each leading eigenvalue, Rayleigh quotient iteration
converges to it, and two more counts certify its number.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrimlens.llm.common import written

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
_EPS = 2.0**-52
_BUNCH_KAUFMAN = (1 + 17**0.5) / 8


# ------------------------------------------------------------------------------------------------- leading eigenvectors


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix lie above the shift: positive pivots of LDL' with blocks of one or two."""
    a = matrix - shift * np.eye(len(matrix))
    positive = 0
    while len(a):
        column = np.abs(a[1:, 0])
        r = int(column.argmax()) + 1 if len(column) else 0
        most = float(column[r - 1]) if r else 0.0
        single = True
        if abs(a[0, 0]) < _BUNCH_KAUFMAN * most:
            other = np.abs(a[r])
            other[r] = 0
            if abs(a[0, 0]) * other.max() < _BUNCH_KAUFMAN * most * most:
                single = abs(a[r, r]) >= _BUNCH_KAUFMAN * other.max()
                swap = (0, r) if single else (1, r)
                a[[swap[0], swap[1]]] = a[[swap[1], swap[0]]]
                a[:, [swap[0], swap[1]]] = a[:, [swap[1], swap[0]]]
        if single:
            pivot = a[0, 0]
            positive += bool(pivot > 0)
            rest = a[1:, 1:]
            a = rest - np.outer(a[1:, 0], a[0, 1:]) / pivot if pivot else rest  # a zero pivot has a zero column
        else:
            block = a[:2, :2]
            positive += 1  # such a block is indefinite
            a = a[2:, 2:] - a[2:, :2] @ np.linalg.solve(block, a[:2, 2:])
    return positive


class Spectrum:
    """Eigenvalues of a covariance counted by inertia; counts are kept, as the brackets of neighbours share them."""

    def __init__(self, matrix: np.ndarray) -> None:
        self.matrix, self.d = matrix, len(matrix)
        self.norm = float(np.abs(matrix).sum(axis=1).max()) if self.d else 0.0
        self.counts: dict[float, int] = {}

    def count(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = above(self.matrix, shift)
        return self.counts[shift]

    def bracket(self, k: int, narrow: float) -> tuple[float, float]:
        """The k-th largest eigenvalue lies in (low, high]: alone there, or in a cluster of width `narrow`."""
        low, high = -self.norm * _EPS * self.d - narrow, self.norm * (1 + 4 * _EPS) + narrow
        for shift, n in self.counts.items():  # what is known already
            if n >= k:
                low = max(low, shift)
        high = min([s for s, n in self.counts.items() if n < k and s > low], default=high)
        while high - low > narrow and (self.count(low) > k or self.count(high) < k - 1):
            middle = (low + high) / 2
            if self.count(middle) >= k:
                low = middle
            else:
                high = middle
        return low, high

    def halve(self, k: int, low: float, high: float) -> tuple[float, float]:
        middle = (low + high) / 2
        return (middle, high) if self.count(middle) >= k else (low, middle)

    def leading(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Up to `most` eigenvalues above rounding, falling, and their unit vectors as rows; numbers are certified by counts."""
        zero = 16 * self.d * _EPS * self.norm
        narrow = 4 * _EPS * self.norm
        values: list[float] = []
        vectors: list[np.ndarray] = []
        for k in range(1, min(most, self.d, self.count(zero) if self.norm else 0) + 1):
            low, high = self.bracket(k, narrow)
            while True:
                value, vector = self._iterate((low + high) / 2, vectors)
                slack = max(narrow, 64 * _EPS * self.norm)
                if low - slack <= value <= high + slack and self.count(value - slack) >= k and self.count(value + slack) < k:
                    break
                if high - low <= narrow:
                    break  # a cluster as narrow as rounding: any vector of its space serves
                low, high = self.halve(k, low, high)
            values.append(value)
            vectors.append(vector)
        return np.array(values), np.array(vectors).reshape(len(values), self.d)

    def _iterate(self, shift: float, found: list[np.ndarray]) -> tuple[float, np.ndarray]:
        """Two steps of inverse iteration from a fixed vector at the bracket's middle, then Rayleigh quotients."""
        known = np.array(found).reshape(len(found), self.d)

        def free(x: np.ndarray) -> np.ndarray:
            for _ in range(2):
                x = x - known.T @ (known @ x)
            return x / np.linalg.norm(x)

        x = free(np.cos(np.arange(1, self.d + 1) * (1 + len(found))))
        value, before = shift, math.inf
        for step in range(40):
            x = free(self._solve(value, x))
            residual = np.linalg.norm(self.matrix @ x - (quotient := float(x @ self.matrix @ x)) * x)
            if residual <= 2 * _EPS * self.norm or (step > 3 and residual >= before):
                return quotient, x
            if step >= 1:
                value, before = quotient, residual
        return value, x

    def _solve(self, shift: float, x: np.ndarray) -> np.ndarray:
        for nudge in (0.0, 1.0, 3.0):
            try:
                out = np.linalg.solve(self.matrix - (shift + nudge * _EPS * self.norm) * np.eye(self.d), x)
                if np.isfinite(out).all():
                    return out / np.abs(out).max()
            except np.linalg.LinAlgError:
                pass
        return x


# ------------------------------------------------------------------------------------------------------- sums over Spark


@dataclass(frozen=True)
class Whitening:
    """Count and sums of the fit list, its nearest whole mean, eigenvalues, unit vectors as rows, trace, and how far the
    whitened fit list's covariance is from the identity (None without any variance)."""

    n: int
    sums: list[int]
    centre: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    @property
    def rest(self) -> list[int]:
        """Sums without n times the whole mean; at most half of n each."""
        return [s - self.n * int(c) for s, c in zip(self.sums, self.centre, strict=True)]

    @property
    def offset(self) -> np.ndarray:
        return np.array([r / self.n for r in self.rest])

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Rows of whole numbers, centred, on each vector, over the root of its eigenvalue."""
        return ((x - self.centre).astype(np.float64) - self.offset) @ (self.vectors / np.sqrt(self.values)[:, None]).T

    def deviations(self, x: np.ndarray) -> list[int] | np.ndarray:
        """Sum of (n x - S)^2 by row, exact."""
        y, rest = x - self.centre, self.rest
        most = self.n * int(np.abs(y).max(initial=0)) + self.n
        if most * most * max(1, len(rest)) < 1 << 62:
            return np.square(self.n * y - np.array(rest, np.int64)).sum(axis=1)
        return [sum((self.n * a - r) ** 2 for a, r in zip(row, rest, strict=True)) for row in y.tolist()]


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _added(rows: DataFrame, shape: tuple[int, int], part: Callable[[np.ndarray], np.ndarray], d: int) -> np.ndarray:
    """Sum of `part(x)` over all rows of column x: by task, then by groups of tasks, then in one."""
    size = shape[0] * shape[1]

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(shape), False
        for batch in batches:
            if batch.num_rows:
                total, seen = total + part(_matrix(batch.column("x"), d)), True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["m"])

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for m in batch.column("m"):
                total += np.frombuffer(m.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["m"])

    some = max(1, math.isqrt(rows.rdd.getNumPartitions()))
    partial = rows.select("x").mapInArrow(tasks, "m binary").repartition(some).mapInArrow(groups, "m binary")
    whole = partial.coalesce(1).mapInArrow(groups, "m binary").first()
    return np.frombuffer(bytes(whole[0])).reshape(shape)


def _fitted(fit: DataFrame, d: int, most: int) -> Whitening | None:
    parts = fit.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.count("*").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s"))
    sums = sorted((r.i, r.n, int(r.s)) for r in parts.collect())  # a row a dimension
    if not sums:
        return None
    n, s = sums[0][1], [v for _, _, v in sums]
    centre = np.array([(2 * v + n) // (2 * n) for v in s], np.int64)
    gram = _added(fit, (d, d), lambda x: (y := (x - centre).astype(np.float64)).T @ y, d)
    rest = [v - n * int(c) for v, c in zip(s, centre, strict=True)]
    # n^2 V in whole numbers: the centre is within half a unit of the mean, so nothing cancels, and one division rounds.
    whole = [[int(g) * n - a * b for g, b in zip(row, rest, strict=True)] for row, a in zip(gram.tolist(), rest, strict=True)]
    covariance = np.array([[v / (n * n) for v in row] for row in whole])
    values, vectors = Spectrum(covariance).leading(most)
    trace = sum(whole[i][i] for i in range(d)) / (n * n)
    model = Whitening(n, s, centre, values, vectors, trace)
    if not len(values):
        return model
    k = len(values)

    def products(x: np.ndarray) -> np.ndarray:
        w = model.whiten(x)
        return np.vstack([w.T @ w, w.sum(axis=0)[None]])

    seen = _added(fit, (k + 1, k), products, d) / n
    error = float(np.abs(seen[:k] - np.outer(seen[k], seen[k]) - np.eye(k)).max())
    return Whitening(n, s, centre, values, vectors, trace, error)


def whole_vectors(vectors: DataFrame, vector_col: str, scale: int = SCALE, shift: int = SHIFT) -> tuple[DataFrame, int]:
    """The rows that can be used, with x = floor(scale * c) + shift for each entry c, and their dimension (0 without any)."""
    v = F.col(vector_col)

    def fits(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(2.0**52 / scale))

    rows = vectors.where(F.coalesce(F.forall(v.cast("array<double>"), fits), F.lit(False)))
    lengths = rows.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = lengths.d if lengths else 0
    x = F.transform(v.cast("array<double>"), lambda c: F.floor(c * scale).cast("long") + F.lit(shift).cast("long"))
    return rows.where(F.size(v) == d).withColumn("x", x), d


def whitening(
    vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, shift: int = SHIFT,
) -> DataFrame:
    """One row per vector that can be used: id, n, deviation (decimal), whitened (an array by component), explained (an array),
    identity_error.

    Each entry c becomes the whole number floor(scale * c) + shift. Each distinct vector of these counts once in the mean, the
    covariance (divisor n) and the components, which are its unit eigenvectors by falling eigenvalue. `deviation` is the sum of
    (n x - S)^2; `whitened` is the centred vector on each component over the root of the eigenvalue; `explained` the eigenvalue's
    share of the trace; `identity_error` the largest entry of the whitened covariance minus the identity.

    Dropped: rows whose vector is null or has null or non-finite entries, or entries beyond 2^52 / scale, and rows of another
    length than the most frequent one (ties: the longer). There are min(components, dimension) components; those without variance
    (one distinct vector, constant or dependent dimensions) have null whitened values and explain 0, all without any variance
    null. Equal eigenvalues share a space: some orthonormal vectors of it, the same for all rows, are taken. A null id stays null,
    repeated rows and ids give a row each, other columns are not read, an empty table gives an empty result.

    What reaches the driver is a matrix of dimension by dimension and the sums, whatever the number of rows.
    """
    shape = "id string, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    plain = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    rows, d = whole_vectors(plain, "v", scale, shift)
    shape = shape.replace("id string", f"id {plain.schema['id'].dataType.simpleString()}", 1)
    model = _fitted(written(rows.select("x").distinct()), d, components) if d else None
    if model is None:
        return vectors.sparkSession.createDataFrame([], shape).withColumnRenamed("id", id_col)
    k, most = len(model.values), min(components, d)
    explained = [v / model.trace for v in model.values.tolist()] + [0.0 if model.trace else None] * (most - k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"), d)
            n = len(x)
            flat = np.full((n, most), np.nan)
            flat[:, :k] = model.whiten(x) if k else 0
            offsets = pa.array(np.arange(n + 1) * most, pa.int32())
            white = pa.ListArray.from_arrays(offsets, pa.array(flat.ravel(), pa.float64(), mask=np.isnan(flat.ravel())))
            deviation = model.deviations(x)
            exact = pa.array(deviation, pa.int64()).cast(pa.decimal128(38, 0)) if isinstance(deviation, np.ndarray) else pa.array(map(Decimal, deviation), pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([model.n] * n, pa.int64()), exact, white, pa.array([explained] * n, pa.list_(pa.float64())),
                 pa.array([model.identity_error] * n, pa.float64())],
                ["id", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("id", "x").mapInArrow(run, shape).withColumnRenamed("id", id_col)
