"""Language identification by rank-order profiles.

A language's profile is the ranking of its most frequent character n-grams.  A
document's most frequent n-grams are ranked the same way and compared with each
profile by the sum of out-of-place distances; the nearest profile wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, materialise
from .mixing import HASH_BITS, hash_of

#: N-grams in a profile.
PROFILE = 400
#: Labelled rows of each language that the profiles are fitted on, about; chosen by hash.
SAMPLE_ROWS = 2_000
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str) -> np.ndarray:
    """Codes of all 1- to 3-grams of letters, words padded by one gap; all else is a gap."""
    s = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    s = np.where(_letters()[s], s, np.uint64(0))
    s = np.concatenate([np.zeros(1, np.uint64), s, np.zeros(1, np.uint64)])
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != 0) | (s[:-1] != 0)
    s = s[keep]
    one = s[s != 0] | np.uint64(3 << 62)
    two = ((s[:-1] << np.uint64(21)) | s[1:] | np.uint64(1 << 63))[(s[:-1] != 0) | (s[1:] != 0)]
    three = ((s[:-2] << np.uint64(42)) | (s[1:-1] << np.uint64(21)) | s[2:])[s[1:-1] != 0]
    return np.concatenate([one, two, three])


def ranked(codes: np.ndarray, most: int) -> np.ndarray:
    """The most frequent codes, ties by code."""
    values, counts = np.unique(codes, return_counts=True)
    return values[np.argsort(-counts, kind="stable")[:most]]


@dataclass(frozen=True)
class Profiles:
    """Languages in code point order and their n-grams by rank."""

    languages: tuple[str, ...]
    tops: tuple[np.ndarray, ...]
    most: int = PROFILE

    def lookup(self) -> list[tuple[np.ndarray, np.ndarray]]:
        return [(t[o], o) for t in self.tops for o in [np.argsort(t)]]

    def predict(self, text: str | None, tables: list[tuple[np.ndarray, np.ndarray]]) -> tuple[str, float]:
        """Language and score: how much nearer the best profile is than the next, from 0 to 1."""
        codes = grams(text) if text else np.zeros(0, np.uint64)
        if not len(codes) or not self.tops:
            return UNKNOWN, 0.0
        top = ranked(codes, self.most)
        place = np.arange(len(top))
        far = []
        for values, ranks in tables:
            at = np.minimum(np.searchsorted(values, top), len(values) - 1)
            far.append(int(np.where(values[at] == top, np.abs(ranks[at] - place), self.most).sum()))
        best = int(np.argmin(far))
        rest = min((d for k, d in enumerate(far) if k != best), default=self.most * len(top))
        return self.languages[best], (1.0 - far[best] / rest if rest else 0.0)


def fit(labelled: DataFrame, most: int = PROFILE, sample_rows: int = SAMPLE_ROWS, key: str = "doc_id") -> Profiles:
    """Profiles from rows (key, text, lang); rows without a language, key or text are left out.

    Whole texts of about ``sample_rows`` rows of each language, chosen by the hash of the key.
    Repeated rows count as often as they are there.  Without any rows there are no profiles.
    """
    rows = labelled.where(f"lang is not null and text is not null and `{key}` is not null").select(F.col(key).alias("key"), "text", "lang")
    upto = (F.least(F.lit(1.0), F.lit(float(sample_rows)) / F.col("count")) * float(1 << HASH_BITS)).cast("long")
    sizes = materialise(rows.groupBy("lang").count().select("lang", upto.alias("upto")))
    rows = rows.join(bounded(sizes), "lang").where(hash_of(F.col("key")) < F.col("upto"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                parts = [grams(t) for t, x in zip(texts, langs, strict=True) if x == lang]
                values, counts = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(values)), pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], names=["lang", "code", "n"])

    sums = rows.select("text", "lang").mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), F.col("code"))
    top = sums.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).orderBy("lang", "rank").collect()
    names = tuple(sorted({r["lang"] for r in top}))
    tops = tuple(np.array([r["code"] for r in top if r["lang"] == x], np.int64).view(np.uint64) for x in names)
    return Profiles(names, tops, most)


def identify(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """``docs`` without ``text`` and with lang_pred and score, from the whole text alone.

    ``und`` and 0 for null texts and texts without a letter.  Columns of these two names are
    replaced; repeated rows are rows of their own; an empty table gives an empty table.
    """
    keep = [c for c in docs.columns if c not in (text, "lang_pred", "score")]
    tables = profiles.lookup()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profiles.predict(t.as_py(), tables) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=[*keep, "lang_pred", "score"]
            )

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema)
    return docs.select(*keep, text).mapInArrow(run, f"{fields}lang_pred string, score double")


def remainder(key: Column, by: int) -> Column:
    """crc32 of the key as text, modulo ``by``; null for null."""
    return F.crc32(key.cast("string").cast("binary")) % by
