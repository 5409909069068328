"""Whitening of embeddings by a randomised range finder.

The covariance is never asked for as a whole unless it must be: each pass over the
centred rows gives its product with a few directions, random ones at first and the
products of the pass before then.  Rayleigh-Ritz turns directions and products into
components and their residuals; where residuals stay too large the directions are all dimensions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .exact import SUMS, matrix, rows_of, total

#: Directions beyond the wanted ones, passes before all dimensions are taken, and the largest residual as a share of the largest eigenvalue.
OVERSAMPLE, PASSES, RESIDUAL = 8, 3, 1e-13
#: Largest magnitude of an entry before the offset: what a long holds.
MOST = float((1 << 63) - (1 << 22))
ROWS = 4_096


def _blocks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            some = batch.slice(at, ROWS)
            yield some, matrix(some.column(column))


class Centre:
    """Number of rows and exact sums of each dimension."""

    def __init__(self, n: int, sums: list[int]) -> None:
        self.n, self.sums = n, np.array(sums, object)
        self.small = max(map(abs, sums), default=0) < 1 << 61

    def times(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, as int64 where that is exact, else as Python integers."""
        if self.small and self.n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) < 1 << 61:
            return x * np.int64(self.n) - self.sums.astype(np.int64)
        return x.astype(object) * self.n - self.sums

    def of(self, times: np.ndarray) -> np.ndarray:
        """x - S / n as doubles."""
        return (times / self.n).astype(np.float64)


def deviations(times: np.ndarray) -> list[int | None]:
    """Exact sum of squares of each row; None where a long can't hold it."""
    about = (times.astype(np.float64) ** 2).sum(1)
    out: list[int | None] = [None] * len(about)
    low = np.flatnonzero(about < 2.0**62)
    rows = times[low].astype(np.int64)
    for i, v in zip(low.tolist(), (rows * rows).sum(1).tolist(), strict=True):
        out[i] = v
    for i in np.flatnonzero((about >= 2.0**62) & (about < 2.0**64)).tolist():
        v = sum(int(t) ** 2 for t in times[i])
        out[i] = v if v < 1 << 63 else None
    return out


def centre(fit: DataFrame, size: int) -> Centre:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(size, object)
        for _, x in _blocks(batches, 0):
            wide = max(abs(int(x.max())), abs(int(x.min()))) >= 1 << 50
            n, sums = n + len(x), sums + (x.astype(object) if wide else x).sum(0).astype(object)
        yield rows_of([*enumerate(sums), (size, n)])

    found = total(fit.mapInArrow(add, SUMS))
    return Centre(found.get(size, 0), [found.get(d, 0) for d in range(size)])


def _summed(fit: DataFrame, shape: tuple[int, int], product: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of a product of ``shape``, which each task adds up first."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(shape)
        for _, x in _blocks(batches, 0):
            out += product(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(out.size)), pa.array(out.ravel())], names=["at", "value"])

    out = np.zeros(shape).ravel()
    for at, value in fit.mapInArrow(add, "at long, value double").groupBy("at").agg(F.sum("value")).collect():
        out[at] = value
    return out.reshape(shape)


def ritz(basis: np.ndarray, image: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``k`` largest eigenvalues with unit eigenvectors in the basis whose image under the covariance is given, and their largest residual."""
    small = basis.T @ image
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, turn = values[::-1][:k], turn[:, ::-1][:, :k]
    vectors = basis @ turn
    worst = np.sqrt(((image @ turn - vectors * values) ** 2).sum(0)).max(initial=0.0)
    return values, vectors, float(worst)


def components(apply: Callable[[np.ndarray], np.ndarray], size: int, k: int, oversample: int = OVERSAMPLE, passes: int = PASSES, residual: float = RESIDUAL) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of what ``apply`` multiplies by, the ``k`` largest."""
    width = k + oversample
    if width < size:
        basis = np.linalg.qr(np.random.default_rng(1).standard_normal((size, width)))[0]
        for _ in range(passes):
            image = apply(basis)
            values, vectors, worst = ritz(basis, image, k)
            if worst <= residual * max(values[0], 0.0):
                return values, vectors
            basis = np.linalg.qr(image)[0]
    basis = np.eye(size)
    return ritz(basis, apply(basis), k)[:2]


def whiten(vectors: DataFrame, k: int = 16, scale: int = 64, offset: int = 1_000_000, oversample: int = OVERSAMPLE, passes: int = PASSES) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for vectors (vec_id, embedding, more).

    Rows whose vector is null or has null, NaN or infinite entries are left out.  An entry becomes
    floor(scale * c) + offset (at most what a long holds); distinct vectors are what is fitted, and each row, repeated ones too, has
    min(k, its size) components.  Vectors of different sizes are fitted apart, each size with its own
    n and identity_error; empty ones have no components.  A component without variance has a null ``whitened``, and
    without any variance ``explained`` is null as well; identity_error is over the others, 0 if there are none.  A deviation beyond a long is null.
    """
    spark = vectors.sparkSession
    entry = lambda c: (F.floor(F.greatest(F.least(c.cast("double") * scale, F.lit(MOST)), F.lit(-MOST))) + offset).cast("long")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = vectors.where(F.col("embedding").isNotNull() & ~bad & (F.size("embedding") > 0)).select("vec_id", F.transform("embedding", entry).alias("x"))
    schema = f"vec_id {kept.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    each = materialise(kept.select("x").distinct().withColumn("size", F.size("x")))
    out = spark.createDataFrame([], schema)
    for i, r in enumerate(each.select("size").distinct().orderBy("size").collect()):  # a model's vectors have one size
        size = r["size"]
        found = _of_size(kept.where(F.size("x") == size), each.where(F.col("size") == size).select("x"), size, min(k, size), schema, oversample, passes)
        out = out.unionByName(found) if i else found
    return out


def _of_size(kept: DataFrame, fit: DataFrame, size: int, k: int, schema: str, oversample: int, passes: int) -> DataFrame:
    mid = centre(fit, size)

    def apply(basis: np.ndarray) -> np.ndarray:
        def product(x: np.ndarray) -> np.ndarray:
            y = mid.of(mid.times(x))
            return y.T @ (y @ basis)

        return _summed(fit, basis.shape, product) / mid.n

    trace = float(_summed(fit, (1, 1), lambda x: np.full((1, 1), (mid.of(mid.times(x)) ** 2).sum()))[0, 0]) / mid.n
    values, directions = components(apply, size, k, oversample, passes)
    live = values > size * np.finfo(float).eps * max(values[0], 0.0)
    turn = directions[:, live] / np.sqrt(values[live])

    def second(x: np.ndarray) -> np.ndarray:
        z = np.column_stack([mid.of(mid.times(x)) @ turn, np.ones(len(x))])
        return z.T @ z

    m = int(live.sum())
    moments = _summed(fit, (m + 1, m + 1), second) / mid.n
    error = float(np.abs(moments[:m, :m] - np.outer(moments[m, :m], moments[m, :m]) - np.eye(m)).max(initial=0.0))
    explained = np.where(live, values, 0.0) / trace if trace else None

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _blocks(batches, 1):
            times = mid.times(x)
            z = np.full((len(x), k), np.nan)
            z[:, live] = mid.of(times) @ turn
            rows = np.repeat(np.arange(len(x)), k)
            cols = [
                batch.column(0).take(pa.array(rows)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(rows), mid.n)),
                pa.array(deviations(times), pa.int64()).take(pa.array(rows)),
                pa.array(z.ravel(), mask=np.isnan(z.ravel())),
                pa.nulls(len(rows), pa.float64()) if explained is None else pa.array(np.tile(explained, len(x))),
                pa.array(np.full(len(rows), error)),
            ]
            yield pa.RecordBatch.from_arrays(cols, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return kept.mapInArrow(project, schema)
