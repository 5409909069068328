"""Clustering of vectors around centroids in exact integers, by partial-distance search.

Vectors are compared with a centroid some dimensions at a time, those that vary most
first; a centroid is abandoned for a vector as soon as its distance so far is above the
vector's best, and what survives is compared in all dimensions.  Sums of clusters are added in
tasks and then by Spark; the driver sees centroids only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .exact import SMALL, SUMS, floored, matrix, rows_of, total

#: Dimensions compared at a time, and vectors.
STEP, ROWS = 8, 4_096


def nearest(x: np.ndarray, centroids: np.ndarray, order: np.ndarray, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (of equal ones the smallest) and squared distance of each row of integers."""
    if x.dtype != centroids.dtype:
        x, centroids = x.astype(object), centroids.astype(object)
    x, centroids = x[:, order], centroids[:, order]
    rows = np.arange(len(x))
    head = x[:, None, :step] - centroids[None, :, :step]
    head = (head * head).sum(2)
    label = start = head.argmin(1)  # a good guess, whose distance is the first best
    rest = x[:, step:] - centroids[start, step:]
    best = head[rows, start] + (rest * rest).sum(1)
    label = label.copy()
    for c in range(len(centroids)):
        live = np.flatnonzero((head[:, c] <= best) & (start != c))
        far = head[live, c]
        for lo in range(step, x.shape[1], step):
            part = x[live, lo : lo + step] - centroids[c, lo : lo + step]
            far = far + (part * part).sum(1)
            stay = (far <= best[live]).astype(bool)
            live, far = live[stay], far[stay]
            if not len(live):
                break
        better = ((far < best[live]) | (c < label[live])).astype(bool)
        label[live[better]], best[live[better]] = c, far[better]
    return label, best


def _blocks(batches: Iterator[pa.RecordBatch], column: int, scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            some = batch.slice(at, ROWS)
            yield some, floored(matrix(some.column(column)).astype(np.float64), scale)


def by_spread(kept: DataFrame, size: int, scale: int) -> np.ndarray:
    """Dimensions by falling variance over all vectors; it decides about speed only."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, ss = 0, np.zeros(size), np.zeros(size)
        for batch in batches:
            x = np.clip(matrix(batch.column(0)).astype(np.float64).reshape(-1, size), -1e100, 1e100) * scale
            n, s, ss = n + len(x), s + x.sum(0), ss + (x * x).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(np.full(size, float(n))), pa.array(s), pa.array(ss)], names=["dim", "n", "s", "ss"])

    rows = kept.select("embedding").mapInArrow(sums, "dim int, n double, s double, ss double").groupBy("dim").agg(*[F.sum(c).alias(c) for c in ("n", "s", "ss")]).collect()
    out = np.zeros(size)
    for r in rows:
        out[r["dim"]] = r["ss"] / r["n"] - (r["s"] / r["n"]) ** 2 if r["n"] else 0.0
    return np.argsort(-out, kind="stable")


def _integers(rows: list[list[int]]) -> np.ndarray:
    small = all(abs(v) < SMALL for row in rows for v in row)
    return np.array(rows, np.int64 if small else object)


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, size: int = 64, scale: int = 64, seed: int = 1) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) for vectors (vec_id, embedding, more).

    Kept are vectors of ``size`` components, none null, NaN or infinite; a component becomes floor(scale * x).
    Centroids start as the ``k`` kept vectors (all, if there are fewer) with the least
    SHA-256 of ``seed:vec_id`` (null ids last, equal ids by their vectors) and move ``rounds`` times to
    the floor of their vectors' mean; without vectors they stay.  Repeated rows are vectors of their own.
    Distances and sums that exceed a long are null.  Without kept vectors the result is empty.
    """
    spark = vectors.sparkSession
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = vectors.select("vec_id", "embedding").where((F.size("embedding") == size) & ~bad)
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(hashed.asc_nulls_last(), "embedding").limit(k).select("embedding").collect()
    found = f"vec_id {kept.schema['vec_id'].dataType.simpleString()}, cluster int, distance long"
    if not first:
        return spark.createDataFrame([], f"{found}, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = _integers(floored(np.array([r[0] for r in first], np.float64), scale).tolist())
    order = by_spread(kept, size, scale)
    for _ in range(rounds):
        sums = total(kept.select("embedding").mapInArrow(_adder(centroids, order, scale), SUMS))
        moved = []
        for c, row in enumerate(centroids.tolist()):
            n = sums.get(c * (size + 1) + size, 0)
            moved.append([sums[c * (size + 1) + d] // n for d in range(size)] if n else row)
        centroids = _integers(moved)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _blocks(batches, 1, scale):
            label, best = nearest(x, centroids, order)
            far = pa.array([v if v < 1 << 63 else None for v in best.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(label, pa.int32()), far], names=["vec_id", "cluster", "distance"])

    named = materialise(kept.mapInArrow(assign, found))
    inertia = F.sum(F.col("distance").cast("decimal(38,0)"))
    each = {r[0]: int(r[1]) if r[2] == r[3] else None for r in named.groupBy("cluster").agg(inertia, F.count("distance"), F.count("*")).collect()}
    whole = None if None in each.values() else sum(each.values())
    fits = lambda v: v if v is not None and v < 1 << 63 else None
    digest = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in centroids.tolist()]
    rows = [(c, fits(each[c]), fits(whole), digest[c]) for c in sorted(each)]
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return named.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows at most


def _adder(centroids: np.ndarray, order: np.ndarray, scale: int):
    """A task's sums by cluster and dimension, and the number of vectors as one more dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, size = centroids.shape
        sums, n = np.zeros((k, size), object), np.zeros(k, np.int64)
        for _, x in _blocks(batches, 0, scale):
            label, _ = nearest(x, centroids, order)
            n += np.bincount(label, minlength=k)
            for c in np.unique(label):
                sums[c] += x[label == c].sum(0).astype(object)
        slots = ((c * (size + 1) + d, sums[c, d]) for c in np.flatnonzero(n) for d in range(size))
        yield rows_of([*slots, *((c * (size + 1) + size, n[c]) for c in np.flatnonzero(n))])

    return add
