"""Whitening of vectors: exact integer moments, pivoted Cholesky, one-sided Jacobi.

Entries become integers (``floor(64 * c) + 1000000``), so that sums and products of all vectors are exact in any order.
Spark adds them up; what reaches the driver is one matrix of the vectors' dimension, whatever the number of rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.llm.common import give_back, stage

# The grid of the entries, and the components returned.
STEPS = 64
OFFSET = 1_000_000
COMPONENTS = 16
#: Entries beyond this size have no exact place on the grid; their vectors are left out like non-finite ones.
LARGEST = 2.0**40
#: A remaining pivot at most this part of the largest variance, times the dimension, is rounding noise.
RANK_TOLERANCE = 2.0**-50


def grid_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id``, ``x``: the vectors on the integer grid.

    Rows go whose vector is null, has no entries, or holds a null, non-finite or larger than ``LARGEST`` entry.
    """
    c = F.col("_v")
    sound = F.forall(c, lambda e: e.isNotNull() & (F.abs(e.cast("double")) <= LARGEST))  # NaN is larger than any number
    x = F.transform(c, lambda e: F.floor(e.cast("double") * STEPS) + OFFSET).alias("x")
    named = df.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("_v"))
    return named.where((F.size(c) > 0) & sound).select("vec_id", x)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of vectors and the sums of their entries: ``width`` + 1 values."""

    def run(batches):
        rows, total = 0, np.zeros(width, dtype=object)
        for batch in batches:
            x = _matrix(batch.column(0), width)
            rows += len(x)
            total += x.sum(axis=0).astype(object)  # a batch of entries below 2**47 cannot overflow
        values = [*total, rows] if rows else []
        yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array(map(str, values), pa.string())], names=["i", "s"])

    found = fit.mapInArrow(run, "i int, s string").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    sums = {r["i"]: int(r["s"]) for r in found}
    return sums.get(width, 0), [sums.get(i, 0) for i in range(width)]


def _products(y: np.ndarray) -> np.ndarray:
    """``y' y`` exactly: in doubles while every sum is below 2**53, else in Python's integers."""
    largest = int(np.abs(y).max(initial=0))
    if largest * largest * len(y) < 2**53:
        doubles = y.astype(np.float64)
        return (doubles.T @ doubles).astype(np.int64).astype(object)
    whole = y.astype(object)
    return whole.T @ whole


def _scatter(fit: DataFrame, near: np.ndarray) -> dict[tuple[int, int], int]:
    """Exact sums of products of the entries less ``near``, the integers next to the mean: a value per pair of dimensions."""
    width = len(near)
    upper = np.triu_indices(width)

    def run(batches):
        total = np.zeros((width, width), dtype=object)
        for batch in batches:
            total += _products(_matrix(batch.column(0), width) - near)
            give_back()
        values = total[upper]
        yield pa.RecordBatch.from_arrays(
            [pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), pa.array([str(v) for v in values], pa.string())], names=["i", "j", "s"]
        )

    found = fit.mapInArrow(run, "i int, j int, s string").groupBy("i", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    return {(r["i"], r["j"]): int(r["s"]) for r in found.collect()}  # dimension squared, halved


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """``F`` with ``matrix = F F'``, one column per pivot, the largest remaining variance first.

    Its rows, taken in pivot order, are a lower triangle. Stops when what remains is rounding noise,
    so that the number of columns is the rank.
    """
    width = len(matrix)
    left, factor = np.diag(matrix).astype(float).copy(), np.zeros((width, width))
    noise = left.max(initial=0.0) * RANK_TOLERANCE * width
    for c in range(width):
        pivot = int(left.argmax())
        if left[pivot] <= noise:
            return factor[:, :c]
        factor[:, c] = (matrix[:, pivot] - factor[:, :c] @ factor[pivot, :c]) / math.sqrt(left[pivot])
        # rows that were pivots before are zero from here on: the triangle
        factor[left == -np.inf, c] = 0.0
        left -= factor[:, c] ** 2
        left[pivot] = -np.inf
    return factor


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """Rotate pairs of columns until all are orthogonal to double precision.

    A sweep visits every pair once in rounds of disjoint pairs, each round one numpy step.
    """
    columns = np.array(factor.T)
    count = len(columns)
    if count < 2:
        return columns.T
    ring = list(range(count + count % 2))
    for _ in range(sweeps):
        rotated = False
        for _ in range(len(ring) - 1):
            pairs = [(a, b) for a, b in zip(ring[: len(ring) // 2], reversed(ring[len(ring) // 2 :])) if a < count and b < count]
            a, b = (np.array(side) for side in zip(*pairs))
            x, y = columns[a], columns[b]
            xx, yy, xy = (x * x).sum(axis=1), (y * y).sum(axis=1), (x * y).sum(axis=1)
            turn = np.abs(xy) > 1e-16 * count * np.sqrt(xx * yy)
            if turn.any():
                rotated = True
                zeta = (yy[turn] - xx[turn]) / (2 * xy[turn])
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
                cos = (1 / np.sqrt(1 + t * t))[:, None]
                sin = t[:, None] * cos
                x, y = x[turn], y[turn]
                columns[a[turn]], columns[b[turn]] = cos * x - sin * y, sin * x + cos * y
            ring = [ring[0], ring[-1], *ring[1:-1]]
        if not rotated:
            break
    return columns.T


@dataclass
class Whitening:
    """``n`` distinct vectors with ``sums``; unit ``components`` (a column each), their ``values``, and the variances' ``total``."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    total: float
    identity_error: float = 0.0

    @property
    def width(self) -> int:
        return len(self.sums)

    def near(self) -> np.ndarray:
        return np.array([round(Fraction(s, self.n)) for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x`` less the mean: the integers next to the mean go first, so that no digit is lost."""
        near = self.near()
        rest = np.array([float(Fraction(s, self.n) - int(m)) for s, m in zip(self.sums, near)])
        return (x - near) - rest

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of ``(n * x - sums)`` squared; null where a long cannot hold one."""
        near = self.near()
        rest = [s - self.n * int(m) for s, m in zip(self.sums, near)]
        y = x - near
        largest = self.n * int(np.abs(y).max(initial=0)) + max(map(abs, rest), default=0)
        if largest < 2**62 and self.width * largest * largest < 2**63:
            return (((self.n * y - np.array(rest, np.int64)) ** 2).sum(axis=1)).tolist()
        whole = ((self.n * y.astype(object) - np.array(rest, dtype=object)) ** 2).sum(axis=1)
        return [int(v) if v < 2**63 else None for v in whole]


def _common_width(vectors: DataFrame) -> int:
    """The length most vectors have, the smaller one on a tie; 0 without vectors."""
    found = vectors.groupBy(F.size("x").alias("w")).count().orderBy(F.desc("count"), "w").first()
    return found["w"] if found else 0


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Learn from ``grid_vectors``, each distinct vector once; None where there is none.

    Vectors of another than the commonest length teach nothing. Equal vectors meet already before the shuffle, so that
    copies of one vector, however many, are one row. Components whose variance is rounding noise are left out.
    """
    width = _common_width(vectors)
    if not width:
        return None
    distinct = stage(vectors.where(F.size("x") == width).select("x").distinct())
    n, sums = _sums(distinct, width)
    model = Whitening(n, sums, np.zeros((width, 0)), np.zeros(0), 0.0)
    near = model.near()
    rest = [s - n * int(m) for s, m in zip(sums, near)]
    covariance = np.zeros((width, width))
    for (i, j), s in _scatter(distinct, near).items():
        # exact numerator, rounded once
        covariance[i, j] = covariance[j, i] = (n * s - rest[i] * rest[j]) / (n * n)
    model.total = float(np.trace(covariance))
    rotated = one_sided_jacobi(pivoted_cholesky(covariance))
    values = (rotated**2).sum(axis=0)
    order = np.argsort(-values, kind="stable")[:components]
    unit = rotated[:, order] / np.sqrt(values[order])
    # one sign for all rows: the largest entry of a component is positive
    signs = np.sign(unit[np.abs(unit).argmax(axis=0), np.arange(unit.shape[1])])
    model.components, model.values = unit * signs, values[order]
    model.identity_error = _identity_error(distinct, model)
    return model


def _identity_error(distinct: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance less the identity, from all of them."""
    count = len(model.values)
    if not count:
        return 0.0

    def run(batches):
        total, products = np.zeros(count), np.zeros((count, count))
        for batch in batches:
            w = model.project(_matrix(batch.column(0), model.width))
            total += w.sum(axis=0)
            products += w.T @ w
        flat = np.concatenate([total, products.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(flat)), pa.int32()), pa.array(flat)], names=["at", "s"])

    # a value per task and place, added in a fixed order so that reruns agree
    parts = distinct.mapInArrow(run, "at int, s double").groupBy("at").agg(F.sort_array(F.collect_list("s")).alias("s"))
    summed = parts.select("at", F.aggregate("s", F.lit(0.0), lambda a, b: a + b).alias("s")).collect()
    flat = np.zeros(count + count * count)
    for r in summed:
        flat[r["at"]] = r["s"]
    mean = flat[:count] / model.n
    covariance = flat[count:].reshape(count, count) / model.n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(count)).max())


def whiten(vectors: DataFrame, model: Whitening) -> DataFrame:
    """``vec_id``, ``deviation`` and ``whitened``, an array with a value per component, of every vector of the fitted length.

    A row per row: repeated and null ids stay as they are.
    """
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(1), model.width)
            values = model.project(x)
            offsets = np.arange(len(x) + 1, dtype=np.int32) * values.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.deviations(x), pa.int64()), lists], names=["vec_id", "deviation", "whitened"])
            give_back()

    fitting = vectors.where(F.size("x") == model.width).select("vec_id", "x")
    return fitting.mapInArrow(run, f"vec_id {kind}, deviation long, whitened array<double>")


def whitened_components(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Vectors that ``grid_vectors`` leaves out, or whose length is not the commonest one, have no row; nor has any vector
    where all are alike, since no component has variance then.
    """
    vectors = grid_vectors(df, vec_id, vector)
    model = fit(vectors, components)
    if model is None or not len(model.values):
        model = model or Whitening(0, [], np.zeros((0, 0)), np.zeros(0), 0.0)
        found = vectors.where("false").select("vec_id", F.lit(0).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened"))
    else:
        found = whiten(vectors, model)
    shares = F.array(*[F.lit(float(v / model.total)) for v in model.values]).cast("array<double>")
    long = found.select("vec_id", "deviation", F.posexplode("whitened").alias("_at", "whitened"))
    return long.select(
        "vec_id",
        (F.col("_at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("_at")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
