"""Collecting the children of parents that may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .walk import shown

#: Parts that a parent's children are dealt to by their ids.
PARTS = 64
#: Bytes, as JSON, of the children that one document may hold.
BUDGET = 256 << 20


def collected(df: DataFrame, key: str, member: str, row: Column, name: str, parts: int = PARTS, budget: int = BUDGET) -> DataFrame:
    """(key, name): a sorted array of ``row`` for each key, as ``sort_array(collect_list(row))`` gives it.

    A key's rows are dealt to ``parts`` groups by ``member`` and sorted there, so that a large key is spread over
    tasks; the second step only merges sorted arrays.  In both steps bytes are added up by a window, which can spill,
    before anything is collected, and a key above ``budget`` ends the query with an error that names it, as a document
    of that size couldn't be held or sent either.  Equal rows are all kept, null members go to one part,
    null keys are a key, and an empty table gives an empty table.
    """

    def checked(at: str, value: str) -> Column:
        told = F.format_string(f"{name}: the children of %s take more than the {budget} bytes that a document may hold", shown(df, key).cast("string"))
        return F.when(F.col(at) > budget, F.raise_error(told)).otherwise(F.col(value)).alias(value)

    rows = df.select(key, F.pmod(F.xxhash64(member), F.lit(parts)).alias("_part"), row.alias("_row"))
    rows = rows.withColumn("_bytes", F.octet_length(F.to_json("_row")).cast("long"))
    so_far = Window.partitionBy(key, "_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.select("*", F.sum("_bytes").over(so_far).alias("_sum")).select(key, "_part", "_bytes", checked("_sum", "_row"))
    some = rows.groupBy(key, "_part").agg(F.sort_array(F.collect_list("_row")).alias("_rows"), F.sum("_bytes").alias("_bytes"))
    every = some.select(key, "_rows", F.sum("_bytes").over(Window.partitionBy(key)).alias("_sum")).select(key, checked("_sum", "_rows"))
    return every.groupBy(key).agg(F.sort_array(F.flatten(F.collect_list("_rows"))).alias(name))
