"""Exact integers of any size in tasks, and sums of them over tasks."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of one part of a sum; a part is below 2**FULL, so that 2**(62 - FULL) tasks can be added.
PART, FULL = 32, 40
#: Largest magnitude with which numpy's integers are exact in squared distances of up to 2**6 components.
SMALL = 1 << 27


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal sizes."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def floored(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite doubles, as int64 where all are small, else as Python integers; ``scale`` is a power of two."""
    top = np.abs(x).max(initial=0.0)
    if top * scale < SMALL:
        return np.floor(x * scale).astype(np.int64)
    whole = lambda v: int(v) * scale if abs(v) >= 2.0**53 else math.floor(v * scale)
    return np.array([[whole(v) for v in row] for row in x.tolist()], object).reshape(x.shape)


def parts(value: int) -> Iterator[tuple[int, int]]:
    """(number, part): value is the sum of part * 2**(PART * number)."""
    k = 0
    while not -(1 << FULL) < value < 1 << FULL:
        yield k, value & ((1 << PART) - 1)
        value, k = value >> PART, k + 1
    yield k, value


#: Rows of a task's sums.
SUMS = "slot long, part int, value long"


def rows_of(sums: Iterable[tuple[int, int]]) -> pa.RecordBatch:
    """Sums by slot as rows for ``total``."""
    found = [(slot, k, v) for slot, value in sums for k, v in parts(int(value))]
    slot, part, value = zip(*found, strict=True) if found else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(slot, pa.int64()), pa.array(part, pa.int32()), pa.array(value, pa.int64())], names=["slot", "part", "value"])


def total(df: DataFrame) -> dict[int, int]:
    """Sum of each slot over all tasks; a row or two of each slot reach the driver."""
    out: dict[int, int] = {}
    for slot, part, value in df.groupBy("slot", "part").agg(F.sum("value")).collect():
        out[slot] = out.get(slot, 0) + (value << (PART * part))
    return out
