"""Line deduplication across documents, with DataFrame operations alone.

Hashes of long lines are range-partitioned and sorted by document and position
inside each hash, so that a stream over them meets a line's first occurrence, that
in the largest document, before all others.  What goes is told by compressed bitmaps
of each document's lines; no text is shuffled to find it.  Lines that hold more than a
small share of a partition are counted by partial aggregation instead of being
brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: What is stripped from both ends of a line (fixed values).
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One in so many rows is looked at to find lines that are too frequent for one task.
LOOK = 64
#: Such a line has over 1/PARTS of a partition's share of rows, so there are fewer than PARTS for each partition.
PARTS = 8
#: Rows of a line among those looked at, at least, for it to count as frequent.
LEAST_SEEN = 4


def lines_of(text: Column) -> Column:
    """A text's lines; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def keys_of(text: Column) -> Column:
    """What makes lines equal: blanks at both ends don't count, nor does the case of A-Z."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)
    low = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.transform(lines_of(low), lambda x: F.btrim(x, F.lit(BLANKS)))


def long_lines(docs: DataFrame, least_chars: int) -> DataFrame:
    """(h1, h2, doc_id, t, pos) for every line of ``docs`` (doc_id, t, text) whose key is that long."""
    rows = docs.select("doc_id", "t", F.posexplode(keys_of(F.col("text"))).alias("pos", "key")).where(F.char_length("key") >= least_chars)
    return rows.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "t", "pos")


def frequent(rows: DataFrame) -> DataFrame:
    """(h1, h2) of lines that would make a task large; results don't depend on which are found."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    seen = rows.where(F.pmod(F.xxhash64("doc_id", "t", "pos"), F.lit(LOOK)) == 0)
    seen = materialise(seen.groupBy("h1", "h2").agg(F.count("*").alias("seen")).where(F.col("seen") >= LEAST_SEEN))
    total = rows.count() / LOOK
    return seen.where(F.col("seen") > total / (PARTS * n)).select("h1", "h2")


def repeats(rows: DataFrame, least_docs: int) -> DataFrame:
    """(doc_id, t, pos) of ``rows`` (materialised) in that many documents and not in the largest of them."""
    hot = F.broadcast(materialise(frequent(rows)))  # fewer than PARTS rows for each shuffle partition
    stream = rows.join(hot, ["h1", "h2"], "left_anti").repartitionByRange("h1", "h2")
    order = Window.partitionBy("h1", "h2").orderBy(F.desc_nulls_last("doc_id"), "pos")
    upto, whole = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fresh = (F.row_number().over(order) == 1) | ~F.lag("doc_id").over(order).eqNullSafe(F.col("doc_id"))
    stream = stream.withColumns({"owner": F.first("doc_id").over(upto), "fresh": fresh.cast("int")}).withColumn("docs", F.sum("fresh").over(whole))
    stays = F.col("doc_id").eqNullSafe(F.col("owner"))
    gone = stream.where((F.col("docs") >= least_docs) & ~stays).select("doc_id", "t", "pos")
    many = rows.join(hot, ["h1", "h2"])
    each = many.groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one"))
    owner = each.groupBy("h1", "h2").agg(F.count("one").alias("docs"), F.max("doc_id").alias("owner")).where(F.col("docs") >= least_docs)
    owner = F.broadcast(materialise(owner.select("h1", "h2", "owner")))  # of ``hot``
    return gone.unionByName(many.join(owner, ["h1", "h2"]).where(~stays).select("doc_id", "t", "pos"))


def bitmaps(gone: DataFrame) -> DataFrame:
    """(doc_id, t, n_dropped, keep) for rows (doc_id, t, pos).

    ``keep`` holds 64 lines a word, bit 0 first, set bits for lines that stay; words whose
    lines all stay are left out.
    """
    words = gone.groupBy("doc_id", "t", F.shiftright("pos", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, pos & 63)")).alias("bits"))
    keep = F.array_sort(F.collect_list(F.struct("word", F.bitwise_not("bits").alias("bits"))))
    return words.groupBy("doc_id", "t").agg(F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"), keep.alias("keep"))


def kept_text(text: Column, keep: Column) -> Column:
    """The lines that a bitmap keeps, joined; a null bitmap keeps all."""
    lines = lines_of(text)
    clear = lambda w: F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.getbit(w["bits"], b) == 0)
    gone = F.flatten(F.transform(keep, lambda w: F.transform(clear(w), lambda b: w["word"] * 64 + b)))
    edges = F.concat(F.array(F.lit(-1)), gone, F.array(F.size(lines)))  # what stays are the gaps between them
    gaps = F.zip_with(F.slice(edges, F.lit(1), F.size(edges) - 1), F.slice(edges, F.lit(2), F.size(edges) - 1), lambda a, b: F.slice(lines, a + 2, b - a - 1))
    return F.when(keep.isNull(), F.coalesce(text, F.lit(""))).otherwise(F.array_join(F.flatten(gaps), "\n"))


def _marked(docs: DataFrame, least_chars: int, least_docs: int) -> DataFrame:
    """``docs`` (doc_id, text, more) with t, n_lines, n_dropped and keep."""
    rows = docs.withColumn("t", F.xxhash64("text"))
    found = materialise(long_lines(rows.select("doc_id", "t", "text"), least_chars))
    gone = materialise(bitmaps(repeats(found, least_docs))).withColumnsRenamed({"doc_id": "_id", "t": "_t"})
    out = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("t") == F.col("_t")), "left").drop("_id", "_t")
    return out.withColumns({"n_lines": F.size(lines_of(F.col("text"))).cast("long"), "n_dropped": F.coalesce("n_dropped", F.lit(0)).cast("long")})


def line_bitmaps(docs: DataFrame, least_chars: int = 40, least_docs: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_lines, n_dropped, keep) for each row, without its text: see ``bitmaps``; a null ``keep`` keeps all lines.

    Lines whose key (``keys_of``) has ``least_chars`` code points or more and is in at least
    ``least_docs`` documents go, except those of the largest document with it, which
    stay however often they are there.  Rows with one key are one document; a null key is a document smaller than
    all others.  Null and empty texts have one line, which stays.  An empty table gives an empty one.
    """
    out = _marked(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), least_chars, least_docs)
    return out.select(F.col("doc_id").alias(key), "n_lines", "n_dropped", "keep")


def drop_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs``, with the lines gone from its texts; all else as in ``line_bitmaps``.  Null texts stay null; any further columns may be there."""
    rows = docs.select(F.struct(*docs.columns).alias("_doc"), F.col(key).alias("doc_id"), F.col(text).alias("text"))
    out = _marked(rows, least_chars, least_docs)
    new = F.when(F.col("text").isNotNull(), kept_text(F.col("text"), F.col("keep")))
    return out.select(*[new.alias(c) if c == text else F.col(f"_doc.`{c}`") for c in docs.columns])


def line_digests(docs: DataFrame, least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256): what ``drop_lines`` leaves of each text, as a digest."""
    out = _marked(docs.select("doc_id", "text"), least_chars, least_docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(kept_text(F.col("text"), F.col("keep")), 256).alias("kept_sha256"))
