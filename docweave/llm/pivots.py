"""Near-deduplication of embeddings with a pivot-permutation index.

Every vector is described by its nearest reference points.  Inverted lists of the
pivots retrieve pairs that share at least ``shared`` of them; each pair is met in
the list of its first shared pivot only and verified there by cosine in double
precision.  Lists are cut into blocks and compared tile by tile; a tile returns
link counts and a spanning forest, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, materialise
from .components import Forest, connected_components

#: Pivots of a vector's description, and how many of them a candidate must share.
NEAREST, SHARED = 8, 2
#: Vectors in a block of a list.
BLOCK = 4_096
#: Pivots at most; they are sent to all tasks.
MOST_PIVOTS = 1_024
#: The most frequent sizes of vectors that are indexed by themselves; others share an index by powers of two.
OWN_SIZES = 32


def n_pivots(n: int) -> int:
    """Grows with the root of the largest label, so that lists grow with the root as well, until there are MOST_PIVOTS; lists grow in proportion then."""
    return 64 * min(MOST_PIVOTS // 64, max(2, ceil(2 * sqrt(n) / 64)))


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def describe(x: np.ndarray, pivots: np.ndarray, nearest: int) -> tuple[np.ndarray, np.ndarray]:
    """Nearest pivots of unit vectors, nearest first, and the same as a set of bits."""
    far = -(x @ pivots.T)
    nearest = min(nearest, len(pivots))
    ids = np.argpartition(far, nearest - 1, axis=1)[:, :nearest]
    ids = np.take_along_axis(ids, np.argsort(np.take_along_axis(far, ids, 1), axis=1, kind="stable"), 1)
    bits = np.zeros((len(x), -(-len(pivots) // 64)), np.uint64)
    for k in range(nearest):
        np.bitwise_or.at(bits, (np.arange(len(x)), ids[:, k] >> 6), np.uint64(1) << (ids[:, k] & 63).astype(np.uint64))
    return ids, bits


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def near_vectors(vectors: DataFrame, least: float = 0.93, nearest: int = NEAREST, shared: int = SHARED, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for rows (vec_id, embedding, label, more).

    Rows are compared if labels are equal and not null and sizes are equal.  Null,
    empty and zero vectors and those with null or non-finite parts link with
    nothing and are components of their own.  Equal vectors are compared once and
    count as links of each other.  Repeated vec_ids are separate rows of one name;
    a null vec_id is never kept.  Recall depends on ``nearest`` and ``shared``;
    what is linked has a cosine of ``least`` or more.
    """
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    rows = vectors.select("vec_id", "label", "embedding").withColumn("ok", F.coalesce(F.col("label").isNotNull() & some & ~bad, F.lit(False)))
    rows = rows.select("vec_id", "ok", "label", "embedding", F.xxhash64("label", "embedding").alias("k1"), F.xxhash64("embedding", F.lit(1)).alias("k2"))
    same = rows.where("ok").groupBy("k1", "k2").agg(F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.count("*").alias("n"), F.min("vec_id").alias("least"))
    part = vectors.schema["embedding"].dataType.elementType
    reps = materialise(same.withColumn("id", F.monotonically_increasing_id()).withColumn("dim", F.size("embedding")))
    own = [r["dim"] for r in reps.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(OWN_SIZES).collect()]
    found = [links_of(reps.where(F.col("dim") == d), least, nearest, shared, block) for d in own]
    rest = reps.where(~F.col("dim").isin(own)).withColumn("room", F.ceil(F.log2("dim")).cast("int"))
    for r in rest.select("room").distinct().orderBy("room").collect() if own else []:  # 31 at most
        # filled up with zeros, which changes no cosine; sizes stay apart as parts of the label
        full = F.concat("embedding", F.array_repeat(F.lit(0).cast(part), F.lit(1 << r["room"]) - F.col("dim")))
        some = rest.where(F.col("room") == r["room"]).withColumns({"embedding": full, "label": F.struct("label", "dim")})
        found.append(links_of(some, least, nearest, shared, block))
    if not found:
        found = [vectors.sparkSession.createDataFrame([], "a long, b long, n long")]
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    links = materialise(links)
    parts = connected_components(links.where("b is not null").select("a", "b"))
    counts = links.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("links"))
    named = reps.select("id", "k1", "k2", "n", "least").join(counts, "id", "left").join(parts.withColumnRenamed("node", "id"), "id", "left")
    named = materialise(named.withColumn("component", F.coalesce("component", "id")))
    first = named.groupBy("component").agg(F.min("least").alias("component_id"))
    label = named.join(first, "component").select("k1", "k2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id", F.lit(True).alias("ok"))
    out = rows.select("vec_id", "ok", "k1", "k2").join(label, ["ok", "k1", "k2"], "left")
    component = F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def links_of(reps: DataFrame, least: float, nearest: int, shared: int, block: int) -> DataFrame:
    """Rows (a, null, n): a part of the links of a; and (a, b, null): links that connect what is linked."""
    spark = reps.sparkSession
    largest = reps.groupBy("label").count().agg(F.max("count")).first()[0]
    chosen = reps.orderBy(F.xxhash64(F.lit("pivot"), "k1", "k2")).limit(n_pivots(largest)).select("embedding").collect()
    points = spark.sparkContext.broadcast(unit(np.array([r[0] for r in chosen], np.float64)))
    shared = min(shared, nearest, len(chosen))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(3))
            if not len(x):
                continue
            ids, bits = describe(unit(x), points.value, nearest)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids.tolist(), pa.list_(pa.int32())), pa.array(bits.view(np.int64).tolist(), pa.list_(pa.int64()))], names=["label", "id", "n", "embedding", "near", "bits"])

    kind = reps.schema["label"].dataType.simpleString()
    part = reps.schema["embedding"].dataType.simpleString()
    rows = reps.select("label", "id", "n", "embedding").mapInArrow(post, f"label {kind}, id long, n long, embedding {part}, near array<int>, bits array<long>")
    rows = materialise(rows, points)
    sizes = rows.select("label", F.explode("near").alias("pivot")).groupBy("label", "pivot").agg(F.count("*").alias("size"))
    sizes = materialise(sizes.withColumn("blocks", F.ceil(F.col("size") / block).cast("int")).where("size > 1"))
    lists = rows.withColumn("pivot", F.explode("near")).drop("near").join(bounded(sizes.drop("size")), ["label", "pivot"])
    lists = lists.withColumn("me", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn("it", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    lists = lists.select("label", "pivot", F.least("me", "it").alias("lo"), F.greatest("me", "it").alias("hi"), (F.col("me") > F.col("it")).alias("second"), "id", "n", "embedding", "bits")

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("second")
        x, bits = unit(_matrix(table.column("embedding"))), _matrix_of_bits(table.column("bits"))
        n, ids = table.column("n").to_numpy(), table.column("id").to_numpy()
        pivot, cut = table.column("pivot")[0].as_py(), int((~table.column("second").to_numpy(zero_copy_only=False)).sum())
        alone = table.column("lo")[0].as_py() == table.column("hi")[0].as_py()
        first, other = slice(0, cut), slice(0, cut) if alone else slice(cut, len(ids))
        links, forest = np.zeros(len(ids), np.int64), Forest(len(ids))
        lower = np.zeros(bits.shape[1], np.uint64)
        lower[: pivot >> 6] = ~np.uint64(0)
        lower[pivot >> 6] = np.uint64((1 << (pivot & 63)) - 1)
        y, others, base = x[other], bits[other], other.start
        for at in range(first.start, first.stop, 256):
            upto = min(at + 256, first.stop)
            both = [bits[at:upto, None, k] & others[None, :, k] for k in range(bits.shape[1])]
            count = sum(np.bitwise_count(b) for b in both)
            before = sum((b & m) != 0 for b, m in zip(both, lower, strict=True))
            hit = (count >= shared) & (before == 0)
            if alone:
                hit[np.arange(upto - at), np.arange(at, upto)] = False
            if not hit.any():
                continue
            hit &= x[at:upto] @ y.T >= least
            i, j = np.nonzero(hit)
            if len(i):
                links[at:upto] += hit @ n[other]
                if not alone:
                    links[other] += n[at:upto] @ hit
                forest.link(i + at, j + base)
        some = np.flatnonzero(links)
        a, b = forest.edges(ids)
        return pa.table(
            {"a": np.concatenate([ids[some], a]), "b": pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(b)]), "n": pa.concat_arrays([pa.array(links[some]), pa.nulls(len(a), pa.int64())])}
        )

    return lists.groupBy("label", "pivot", "lo", "hi").applyInArrow(compare, "a long, b long, n long")


def _matrix_of_bits(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(column), -1)
