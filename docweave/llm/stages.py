"""Stages of a corpus pipeline: each applies an operator's decisions to whole documents.

Every function takes documents with any columns, among them doc_id, text, source,
and returns the same columns.  No name of a column is reserved.  Repeated rows and null
ids are rows of their own, null texts count as empty, and an empty table gives an empty
table, unless a function says otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import mixing, secrets, toxicity
from .common import bounded, chunks, materialise, small_batches
from .decontaminate import contamination
from .simhash import near_texts, sketches


def _hashes(*of: Column) -> list[Column]:
    """Two independent hashes that name a value; nulls differ from all else."""
    marks = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("null")) for c in of]
    return [F.xxhash64(*marks).alias("_k1"), F.xxhash64(F.lit(1), *marks).alias("_k2")]  # the seed first: a last column would hash the first hash


def _matched(docs: DataFrame, keys: DataFrame, how: str, *of: Column) -> tuple[DataFrame, list[str]]:
    """``docs`` joined (left_anti or left_semi) with ``keys`` (_k1, _k2), broadcast if they are few, on their hashes; and
    the names of the two columns of hashes, none of which ``docs`` has."""
    end = "_"
    while {f"_k1{end}", f"_k2{end}"} & set(docs.columns):
        end += "_"
    names = [f"_k1{end}", f"_k2{end}"]
    marked = docs.withColumns(dict(zip(names, _hashes(*of), strict=True)))
    return marked.join(bounded(keys.select(F.col("_k1").alias(names[0]), F.col("_k2").alias(names[1]))), names, how), names


def _without(docs: DataFrame, keys: DataFrame, *of: Column) -> DataFrame:
    """Rows of ``docs`` whose hashes aren't among ``keys`` (_k1, _k2)."""
    out, names = _matched(docs, keys, "left_anti", *of)
    return out.drop(*names)


def reject_toxic(docs: DataFrame, labels: DataFrame, least: float = 0.7) -> DataFrame:
    """Documents that score below ``least``; the machine is trained on the labelled ones among them.

    Without labels, or with labels of one kind only, all score the same: 0 without toxic ones.
    """
    small_batches(docs.sparkSession)
    machine = toxicity.fit(docs, labels)
    where = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for first, end, at, raw in chunks(batch.column(where)):
                keep[first:end] = machine.scores(at, raw) < least
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def one_of_each(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, width: int = 4) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest doc_id, one of equal rows.

    Near-duplicates are connected by pairs whose sets of shingles have at least this Jaccard similarity.
    Texts without words are equal to each other.  A null id is chosen only from a group without others.
    """
    small_batches(docs.sparkSession)
    id_, text = F.col("doc_id"), F.col("text")
    rows = materialise(sketches(docs.select("doc_id", *_hashes(id_, text), "text"), shingle, width))
    known = rows.groupBy("fp", "more", "same", "n").agg(F.min("doc_id").alias("least"), F.min(F.struct("_k1", "_k2")).alias("one"))
    known = materialise(known.select("fp", "more", "same", "n", "least", "one.*", F.monotonically_increasing_id().alias("id")))
    near = near_texts(known, docs.select(*_hashes(id_, text), "text"), shingle, similarity)
    named = known.join(near, "id", "left").withColumn("component", F.coalesce("component", "id"))
    named = materialise(named.select("fp", "more", "same", "component", "least"))
    first = named.groupBy("component").agg(F.min("least").alias("first"))
    of = materialise(named.join(first, "component").select("fp", "more", "same", "component", "first"))
    # the group's rows with its smallest key; among several of them the least hash stays
    each = materialise(rows.join(of, ["fp", "more", "same"]))
    mine = each.where(id_.eqNullSafe(F.col("first")))
    stay = materialise(mine.groupBy("component").agg(F.min(F.struct("_k1", "_k2")).alias("k")).select("k.*"))
    gone = materialise(each.select("_k1", "_k2").distinct().join(stay, ["_k1", "_k2"], "left_anti"))
    out = _without(docs, gone, id_, text)
    twice = materialise(each.join(stay, ["_k1", "_k2"], "left_semi").groupBy("_k1", "_k2").count().where("count > 1").select("_k1", "_k2"))
    if twice.isEmpty():
        return out
    again, names = _matched(docs, twice, "left_semi", id_, text)
    again = again.dropDuplicates(names).drop(*names)
    return _without(out, twice, id_, text).unionByName(again)


def decontaminate(docs: DataFrame, items: DataFrame, least_items: int = 1) -> DataFrame:
    """Documents in which fewer than ``least_items`` items have an occurring window; all of them without items."""
    small_batches(docs.sparkSession)
    text = F.col("text")
    found = contamination(docs.select(F.struct(*_hashes(text)).alias("doc_id"), "text"), items, least_items=least_items)
    gone = materialise(found.where("contaminated").select("doc_id.*").distinct())
    return _without(docs, gone, text)


def redact_secrets(docs: DataFrame) -> DataFrame:
    """All documents, with a mark of its kind for each secret in a text; null texts stay null."""
    small_batches(docs.sparkSession)
    return secrets.redact(docs)


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Documents as often as the mix takes them, with ``copy`` from 1 on, which replaces a column of that name.

    Texts without words are never taken; a null source is a source.
    """
    rows = docs.select("source", mixing.n_words(F.col("text")).alias("size"), mixing.hash_of(F.col("doc_id")).alias("hash"))
    rows = materialise(rows)
    sizes = materialise(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    edge = mixing.thresholds(rows, mixing.targets(sizes, list(weights), share, most))
    cols = [c for c in docs.columns if c != "copy"]
    marked = docs.select(F.struct(*cols).alias("_doc"), "source", mixing.n_words(F.col("text")).alias("size"), mixing.hash_of(F.col("doc_id")).alias("hash"))
    out = mixing.taken(marked, edge).where("copies > 0")
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_doc.*", "copy")
