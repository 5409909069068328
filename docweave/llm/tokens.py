"""Token counts from an exact histogram of encoded lengths."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import buffers, materialise, running

#: Ranks of a byte-level BPE, one "base64 rank" a line.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How this vocabulary splits a text before merging (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A vocabulary file is sent to all tasks, so its size is checked.
MOST_BYTES = 64 << 20

_encoders: dict[int, tiktoken.Encoding] = {}


def encoder(data: bytes, pattern: str) -> tiktoken.Encoding:
    key = hash((data, pattern))
    if key not in _encoders:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}
        _encoders[key] = tiktoken.Encoding("docweave", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encoders[key]


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN, text: str = "text") -> DataFrame:
    """``docs`` without ``text`` and with n_tokens (long): the length of the whole encoded text, null 0.

    Rows are counted one by one, repeated ones too.  Other columns stay but for one named ``n_tokens``, which
    is replaced; an empty table gives an empty table.  The file is read by the driver and sent along; executors need no copy of it.
    """
    with open(vocabulary, "rb") as f:
        data = f.read(MOST_BYTES + 1)
    if len(data) > MOST_BYTES:
        raise ValueError(f"{vocabulary} is larger than {MOST_BYTES} bytes")
    sent = docs.sparkSession.sparkContext.broadcast(data)
    keep = [c for c in docs.columns if c not in (text, "n_tokens")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(sent.value, pattern).encode_ordinary
        for batch in batches:
            at, raw = buffers(batch.column(batch.num_columns - 1))
            sizes = [len(encode(raw[a:b].tobytes().decode("utf-8", "replace"))) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.array(sizes, np.int64))], names=[*keep, "n_tokens"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema)
    return docs.select(*keep, text).mapInArrow(run, f"{fields}n_tokens long")


def length_histogram(counts: DataFrame) -> DataFrame:
    """One row for each length that occurs, with its suffix sums.

    n_tokens, n_docs; docs_at_least and tokens_at_least over documents of that
    length or more; tokens_truncated, the total if texts are cut at that length;
    rank, how many documents are as long or shorter.  An empty table gives none.
    """
    bins = counts.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))
    sums = {"docs_at_least": F.col("n_docs"), "tokens_at_least": F.col("n_docs") * F.col("n_tokens")}
    out = materialise(running(bins, [F.col("n_tokens").desc()], sums))
    whole = out.agg(F.max("docs_at_least"), F.max("tokens_at_least")).first()
    n = F.col("n_tokens")
    longer = F.col("docs_at_least") - F.col("n_docs")
    return out.withColumns(
        {
            "tokens_truncated": F.lit(whole[1]) - F.col("tokens_at_least") + n * F.col("n_docs") + n * longer,
            "rank": F.lit(whole[0]) - longer,
        }
    )


class Lengths:
    """Answers for every context limit from a length histogram."""

    def __init__(self, histogram: DataFrame) -> None:
        self.h = histogram

    def _first(self, where: str) -> tuple | None:
        return self.h.where(where).orderBy("n_tokens").first()

    def docs(self) -> int:
        return self.h.agg(F.max("docs_at_least")).first()[0] or 0

    def total(self) -> int:
        return self.h.agg(F.max("tokens_at_least")).first()[0] or 0

    def quantile(self, q: float) -> int | None:
        """The least length that a share ``q`` of the documents doesn't exceed."""
        r = self._first(f"rank >= {max(1, -int(-q * self.docs() // 1))}")
        return r["n_tokens"] if r else None

    def truncated(self, limit: int) -> int:
        """Total of min(length, limit)."""
        r = self._first(f"n_tokens > {int(limit)}")
        return self.total() - (r["tokens_at_least"] - limit * r["docs_at_least"] if r else 0)


def histogram_of(spark: SparkSession, docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    return length_histogram(token_counts(docs.select("text"), vocabulary))
