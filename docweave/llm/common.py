"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows up to which a table may be broadcast; beyond it every operator joins by shuffle.
BROADCAST_ROWS = 100_000
#: Bytes of files up to which it may be.
BROADCAST_BYTES = 8 << 20
#: Bits of a map of hashes that is sent to all tasks: 16 MB at most.
MAP_BITS = 1 << 27
#: Bytes of a batch of rows on its way to Python, about, unless the session asks for less.
BATCH_BYTES = 2 << 20
#: Bytes of text that one vectorised step holds at a time.
CHUNK_BYTES = 1 << 18

_written: list[tuple[SparkSession, str]] = []


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound batches on their way to Python by bytes, as texts differ a thousandfold in length; a smaller bound of the session stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int(spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch())
    if now > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a local one only where that is unset and all is one process (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found and not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return (found or "/tmp/checkpoints/docweave").rstrip("/")


def materialise(df: DataFrame, *sent: Broadcast) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives the plans above it the
    real size of the table.  Files go when the driver ends, or with ``forget``.
    What was ``sent`` for ``df`` alone goes from all executors.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for x in sent:
        x.destroy()
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def forget() -> None:
    """Delete every table that ``materialise`` wrote."""
    while _written:
        spark, path = _written.pop()
        try:
            jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)
        except Exception:  # noqa: BLE001  the session has ended already
            return


atexit.register(forget)


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (materialised before) with a broadcast hint if it is that small in rows and in bytes."""
    known = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if known <= size and df.limit(rows + 1).count() <= rows else df


def hash_map(df: DataFrame, column: str) -> np.ndarray:
    """One bit for each value of a column of hashes, at most MAP_BITS of them.

    What isn't in the map isn't among the values; the share of others that are
    grows with their number.  The driver gets 64 bits a row, so 2 M rows at most.
    """
    n = df.count()
    bits = min(MAP_BITS, 1 << max(16, (256 * n).bit_length()))
    slots = df.select(F.col(column).bitwiseAND(F.lit(bits - 1)).alias("slot"))
    words = slots.groupBy(F.shiftright("slot", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("b")).toPandas()
    out = np.zeros(bits // 64, np.uint64)
    out[words["w"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64).view(np.uint64)
    return out


def in_map(known: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = (values & np.uint64(len(known) * 64 - 1)).astype(np.int64)
    return (known[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0


def running(df: DataFrame, order: list[Column], sums: dict[str, Column], rank: str | None = None) -> DataFrame:
    """Add running sums (inclusive) and a row number over all rows without a one-task window.

    Rows are range-partitioned by ``order``, numbered inside their partition, and
    shifted by the totals of the partitions before, of which there are as many as
    shuffle partitions.  ``order`` must identify rows for reruns to agree.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialise(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()))
    of = {**{name: c.cast("long") for name, c in sums.items()}, **({rank: F.lit(1).cast("long")} if rank else {})}
    totals = dealt.groupBy("_part").agg(*[F.sum(c).alias(f"_t_{k}") for k, c in of.items()])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_part", *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_b_{k}") for k in of])
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = dealt.join(F.broadcast(totals), "_part")  # a row for each shuffle partition
    out = out.withColumns({k: F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"_b_{k}") for k, c in of.items()})
    return out.drop("_part", *[f"_b_{k}" for k in of])


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (int64, one more than rows) and bytes of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return at, raw


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of rows of about ``size`` bytes, one long text alone at most.

    Yields first row, end row, offsets from 0 and bytes.
    """
    at, raw = buffers(column)
    row, n = 0, len(at) - 1
    while row < n:
        end = min(n, max(row + 1, int(np.searchsorted(at, at[row] + size, "right")) - 1))
        yield row, end, at[row : end + 1] - at[row], raw[at[row] : at[end]]
        row = end


def pieces(column: pa.Array, overlap: int, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, int, bool, np.ndarray, np.ndarray]]:
    """As ``chunks``, but a text longer than ``size`` comes in parts, each of which shares ``overlap`` bytes with the next.

    Yields first row, end row, place of the part in its text, whether it is the last
    of it, offsets from 0 and bytes.
    """
    for first, end, at, raw in chunks(column, size):
        if end - first > 1 or len(raw) <= size + overlap:
            yield first, end, 0, True, at, raw
            continue
        for lo in range(0, len(raw) - overlap, size):
            part = raw[lo : lo + size + overlap]
            yield first, end, lo, lo + size + overlap >= len(raw), np.array([0, len(part)]), part


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Groups of neighbouring rows with equal ``keys`` (integers), each as a table, from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys], 1)
        cuts = [0, *(np.flatnonzero((values[1:] != values[:-1]).any(1)) + 1).tolist(), batch.num_rows]
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            now = tuple(values[i])
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(i, j - i))
            last = now
    if held:
        yield pa.Table.from_batches(held)
