"""Mixing sources to target weights by hash-threshold histograms.

Everything runs as DataFrame operations.  Sizes are summed by source and hash
bucket; the bucket in which a source's budget ends is refined with the next bits
of the hash until it holds a single hash value; rows are then filtered by their
source's threshold, without sorting them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, materialise, running

#: Bits of the hash and of one histogram.
HASH_BITS, STEP_BITS = 60, 12


def hash_of(key: Column) -> Column:
    """The first 60 bits of the MD5 of a key's text; a null key has its own."""
    text = F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit("null"))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """Budget of each source: (source, source_size) -> (source, source_size, target).

    Sources in code point order, null last, take the weights in turn; the whole
    budget is ``share`` of all sizes.  A source stops at ``most`` times its size and
    the excess goes to the others by weight, until none is above.
    """
    n = len(weights)
    ranked = running(sizes.withColumn("_none", F.col("source").isNull()), [F.col("_none"), F.col("source")], {}, rank="_rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("_rank") - 1, F.lit(n)) + 1).cast("int"))
    ranked = ranked.withColumn("_w", weight).withColumn("_cap", F.lit(float(most)) * F.col("source_size"))
    # A source is capped before another if its cap is reached at a lower rate, so the
    # capped ones are a prefix by cap / weight.
    ratio = F.col("_cap") / F.col("_w")
    by_rate = running(ranked.withColumn("_rate", ratio), [F.col("_rate"), F.col("_rank")], {"_wn": F.col("_w") * 1_000_000, "_cn": F.col("source_size")})
    by_rate = materialise(by_rate)
    total = by_rate.agg(F.sum("source_size").alias("s"), F.sum(F.col("_w") * 1_000_000).cast("long").alias("w")).first()
    if not total["s"]:
        return by_rate.select("source", "source_size", F.lit(0.0).alias("target"))
    # Rate if the sources before a row are capped; the first row whose cap is above that ends the prefix.
    before_w, before_s = F.col("_wn") - F.col("_w") * 1_000_000, F.col("_cn") - F.col("source_size")
    rate = (F.lit(share * total["s"]) - F.lit(float(most)) * before_s) / (F.lit(float(total["w"])) - before_w) * 1_000_000
    free = by_rate.withColumn("_at", rate).where("_rate > _at").agg(F.min(F.struct("_rate", "_rank", "_at")).alias("x")).first()["x"]
    level = F.lit(float(free["_at"]) if free else float("inf"))
    return by_rate.select("source", "source_size", F.least("_cap", F.when(F.col("source_size") == 0, 0.0).otherwise(level * F.col("_w"))).cast("double").alias("target"))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, source_size, target, base, threshold) for rows (source, size, hash).

    Every row is taken ``base`` times, and once more if its hash is below the
    threshold: the greatest run of whole hash values within what is left of the
    target, and one value more if that comes nearer.
    """
    base = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    open_ = budgets.withColumn("base", base).withColumn("left", F.col("target") - F.col("base") * F.col("source_size"))
    found = materialise(open_.select("source", "source_size", "target", "base", "left", F.lit(0).cast("long").alias("prefix"), F.lit(0.0).alias("done")))
    for used in range(STEP_BITS, HASH_BITS + 1, STEP_BITS):
        shift = HASH_BITS - used
        bucket = F.shiftright("hash", shift)
        edge = found.select("source", "left", "done", "prefix")
        inside = rows.where("size > 0").join(bounded(edge), rows["source"].eqNullSafe(edge["source"]) & (F.shiftright("hash", shift + STEP_BITS) == edge["prefix"]))
        bins = inside.groupBy(rows["source"], bucket.alias("bucket")).agg(F.sum("size").alias("size"), F.first("left").alias("left"), F.first("done").alias("done"))
        upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)  # 4096 rows a source at most
        sums = bins.withColumn("upto", F.col("done") + F.sum("size").over(upto)).withColumn("below", F.col("upto") - F.col("size"))
        take = (F.col("upto") <= F.col("left")) if shift else (F.col("upto") + F.col("below") <= 2 * F.col("left"))
        first = sums.where(~take).groupBy("source").agg(F.min(F.struct("bucket", "below")).alias("x"))
        found = materialise(
            found.alias("f").join(first.alias("g"), F.col("f.source").eqNullSafe(F.col("g.source")), "left").select(
                *[F.col(f"f.{c}") for c in ("source", "source_size", "target", "base", "left")],
                # no such bucket: all of what is inside is taken, and so the edge is the prefix after it
                F.coalesce(F.col("g.x.bucket"), (F.col("f.prefix") + 1) * (1 << STEP_BITS)).alias("prefix"),
                F.coalesce(F.col("g.x.below"), F.col("f.done")).alias("done"),
            )
        )
    return found.select("source", "source_size", "target", "base", F.col("prefix").alias("threshold"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, source: str = "source", key: str = "doc_id", text: str = "text") -> DataFrame:
    """Sizes and takes of every row: doc_id, source, size, source_size, target, base, copies, taken.

    Size is the number of words in a text, null 0.  ``copies`` is how often the mix
    takes the row, at most ``most`` rounded up.  Equal keys share a hash, so they go
    together, and reruns agree.  An empty table gives an empty table; if no text has
    a word, nothing is taken.
    """
    rows = materialise(docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"), hash_of(F.col(key)).alias("hash")))
    sizes = materialise(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    edge = thresholds(rows, targets(sizes, list(weights), share, most))
    return taken(rows, edge)


def taken(rows: DataFrame, edge: DataFrame) -> DataFrame:
    edge = bounded(edge).withColumnRenamed("source", "_source")
    out = rows.join(edge, rows["source"].eqNullSafe(edge["_source"])).drop("_source")
    copies = F.col("base") + (F.col("hash") < F.col("threshold")).cast("int")
    out = out.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(F.lit(0)))
    return out.withColumn("taken", F.col("copies") * F.col("size")).drop("hash", "threshold")
