"""Reducing every full window of consecutive offsets, and then the windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_FN = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}
#: Offsets of a key that one group of a task holds, besides those that it looks ahead.
BLOCK = 1 << 16


def sliding_window(df: DataFrame, key: str, offset: str, value: str, size: int, fn: str, over: str, name: str, block: int = BLOCK) -> DataFrame:
    """(key, name): ``over`` of ``fn`` over each window of ``size`` offsets without a hole.

    Offsets are whole numbers, once each for a key; rows without one are left out.
    Keys without a full window have no row.  A key's offsets are cut into blocks, each of which also gets the
    first ``size - 1`` offsets of the next, so that a key of any length is spread over tasks; what windows give is
    reduced by key before it is exchanged.
    """
    block = max(block, 2 * size)
    rows = df.where(F.col(offset).isNotNull()).select(key, F.col(offset).cast("long").alias("_at"), F.col(value).alias("_value"))
    inside = F.pmod("_at", F.lit(block))
    own = F.expr(f"(_at - pmod(_at, {block})) div {block}")
    blocks = F.when(inside < size - 1, F.array(own, own - 1)).otherwise(F.array(own))
    rows = rows.withColumn("_own", own).withColumn("_block", F.explode(blocks))
    ahead = Window.partitionBy(key, "_block").orderBy("_at").rangeBetween(0, size - 1)
    windows = rows.select(key, "_own", "_block", _FN[fn]("_value").over(ahead).alias("_in"), F.count("*").over(ahead).alias("_n"))
    windows = windows.where((F.col("_n") == size) & (F.col("_own") == F.col("_block")))
    return windows.groupBy(key).agg(_FN[over]("_in").alias(name))
