"""Benchmark decontamination by winnowing.

The k-gram with the least hash in every window of w k-grams is kept, on both
sides; with k + w - 1 words in an item window, every window that occurs in a
document has a kept k-gram in common with it.  Kept k-grams are joined and
compared word by word, and each hit is extended to both sides.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, chunks, hash_map, in_map, materialise, small_batches
from .words import Words, parts, winnow

_HITS = "m int, fp long, pos int, gram string, before array<string>, after array<string>"
#: Marks that are held as strings at a time; a text may have as many as words.
MARKS = 4096


def _marks(w: Words, window: int, k: int, short: list[int]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(m, length of the gram, positions, hashes): kept k-grams for m = window, all m-grams for shorter items."""
    grams = w.grams(k)
    at = winnow(grams, w.starts(window), window - k + 1)
    yield window, k, at, grams[at]
    for m in short:
        grams = w.grams(m)
        at = np.flatnonzero(w.starts(m))
        yield m, m, at, grams[at]


def _batch(ids: pa.Array, m: Sequence, fp: Sequence, pos: Sequence, gram: Sequence, before: Sequence, after: Sequence) -> pa.RecordBatch:
    words = pa.list_(pa.string())
    cols = zip((m, fp, pos, gram, before, after), (pa.int32(), pa.int64(), pa.int32(), pa.string(), words, words), strict=True)
    return pa.RecordBatch.from_arrays([ids, *[pa.array(x, t) for x, t in cols]], names=["id", "m", "fp", "pos", "gram", "before", "after"])


def _scan(rows: DataFrame, window: int, k: int, short: list[int], item: bool, seen: object) -> DataFrame:
    """For each row (id, text) a row with m = 0 and its number of words as pos, and one for each mark."""
    side = window - k

    def found(w: Words, known: np.ndarray | None, before: int = 0) -> Iterator[tuple]:
        counts = w.counts()
        for m, size, pos, fp in _marks(w, window, k, short if not item else sorted({int(n) for n in counts if 0 < n < window})):
            if known is not None:
                hit = in_map(known, fp ^ np.uint64(m))
                pos, fp = pos[hit], fp[hit]
            row = np.searchsorted(w.at, pos, "right") - 1
            if item:  # a short item is one window; a long one has no shorter ones
                own = counts[row] == m if m < window else counts[row] >= window
                pos, fp, row = pos[own], fp[own], row[own]
            for i in range(0, len(pos), MARKS):
                part = slice(i, i + MARKS)
                for p, h, r in zip(pos[part].tolist(), fp[part].view(np.int64).tolist(), row[part].tolist(), strict=True):
                    lo, hi = (max(p - side, int(w.at[r])), min(p + size + side, int(w.at[r + 1]))) if m == window else (p, p + size)
                    words = w.slice(lo, hi)
                    yield r, m, h, before + p - int(w.at[r]), " ".join(words[p - lo : p - lo + size]), words[: p - lo][::-1], words[p - lo + size :]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = seen.value if seen is not None else None
        for batch in batches:
            for first, end, at, raw in chunks(batch.column(1), CHUNK_BYTES):
                n = end - first
                ids, counts = batch.column(0).slice(first, n), None
                # a long text comes in parts that share all but one of a window's words, so that every window lies in one of them
                for before, w in parts(raw, window - 1, CHUNK_BYTES) if len(raw) > CHUNK_BYTES else [(0, Words(at, raw))]:
                    counts = before + w.counts()
                    marks = found(w, known, before)
                    while part := list(islice(marks, MARKS)):
                        r, *cols = zip(*part, strict=True)
                        yield _batch(ids.take(pa.array(r, pa.int64())), *cols)
                yield _batch(ids, [0] * n, [0] * n, counts, [""] * n, [[]] * n, [[]] * n)

    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, {_HITS}")


def _equal(side: str) -> Column:
    """Number of leading words that both lists share."""
    a, b = F.col(f"d.{side}"), F.col(f"b.{side}")
    both = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y) & x.isNotNull())
    off = F.array_position(both, F.lit(False))
    return F.when(off == 0, F.size(both)).otherwise(off - 1).cast("int")


def contamination(docs: DataFrame, items: DataFrame, window: int = 8, k: int = 5, least_items: int = 2) -> DataFrame:
    """Hits of benchmark windows in documents.

    ``docs`` (doc_id, text, more), ``items`` (item_id, text, more).  A window is
    ``window`` consecutive words of an item; an item of fewer, but not none, is one
    window.  Returns, for each row of ``docs``, repeated and null ids included:
    doc_id, n_words, n_hit (words inside any occurrence), n_items, item_ids (sorted
    strings), spans (merged word ranges), contaminated (n_items >= least_items).
    Null texts have no words; long ones are worked on in parts; items with null ids count for hits but aren't listed.
    Needs 1 <= k <= window.
    """
    short_of = lambda df: [r[0] for r in df.where(f"m > 0 and m < {window}").select("m").distinct().collect()]  # noqa: E731  under ``window`` rows
    spark = docs.sparkSession
    small_batches(spark)
    bench = materialise(_scan(items.select(F.col("item_id").alias("id"), F.col("text").cast("string").alias("text")), window, k, [], True, None).where("m > 0"))
    seen = spark.sparkContext.broadcast(hash_map(bench.select(F.col("fp").bitwiseXOR(F.col("m").cast("long")).alias("mark")), "mark"))
    rows = docs.select(F.struct(F.monotonically_increasing_id().alias("r"), F.col("doc_id")).alias("id"), F.col("text").cast("string").alias("text"))
    found = materialise(_scan(rows, window, k, sorted(short_of(bench)), False, seen), seen)

    same = ["m", "fp", "gram", "before", "after"]
    kinds = materialise(bench.select(*same, F.xxhash64(*same).alias("class"), F.col("id").cast("string").alias("item_id")).distinct())
    classes = kinds.select(*same, "class").distinct()
    hit = found.where("m > 0").alias("d").join(classes.alias("b"), ["m", "fp", "gram"])
    left, right = (F.when(F.col("m") < window, 0).otherwise(_equal(s)) for s in ("before", "after"))
    length = F.when(F.col("m") < window, F.col("m")).otherwise(k)
    hit = hit.select(F.col("id.r").alias("r"), "class", "m", (F.col("pos") - left).alias("i"), (F.col("pos") + length + right).alias("j"))
    hit = materialise(hit.where(F.col("j") - F.col("i") >= F.col("m")))
    of = hit.select("r", "class").distinct().join(kinds.where("item_id is not null").select("class", "item_id"), "class")
    of = of.groupBy("r").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    spans = hit.groupBy("r").agg(F.array_sort(F.collect_set(F.struct("i", "j"))).alias("spans"))
    joined = F.aggregate(
        "spans",
        F.expr("cast(array() as array<struct<i:int,j:int>>)"),
        lambda done, x: F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["j"] >= x["i"]), F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.struct(F.try_element_at(done, F.lit(-1))["i"].alias("i"), F.greatest(F.try_element_at(done, F.lit(-1))["j"], x["j"]).alias("j"))))).otherwise(
            F.concat(done, F.array(F.struct(x["i"].cast("int").alias("i"), x["j"].cast("int").alias("j"))))
        ),
    )
    spans = spans.select("r", joined.alias("spans"))
    out = found.where("m = 0").select(F.col("id.r").alias("r"), F.col("id.doc_id").alias("doc_id"), F.col("pos").cast("long").alias("n_words"))
    out = out.join(spans, "r", "left").join(of, "r", "left")
    n_hit = F.aggregate(F.coalesce("spans", F.expr("cast(array() as array<struct<i:int,j:int>>)")), F.lit(0).cast("long"), lambda s, x: s + x["j"] - x["i"])
    out = out.withColumns({"n_hit": n_hit, "item_ids": F.coalesce("item_ids", F.expr("cast(array() as array<string>)"))})
    n_items = F.size("item_ids").cast("long")
    return out.select("doc_id", "n_words", "n_hit", n_items.alias("n_items"), "item_ids", "spans", (n_items >= least_items).alias("contaminated"))
