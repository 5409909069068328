"""Walking the graph: edges and chains of edges as (near, far) pairs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import Hop, id_column
from ..sources.graph import GraphSource


def pairs(source: GraphSource, hop: Hop) -> DataFrame:
    """(near, far): ids of the node that the hop starts from and of the one it leads to."""
    child = hop.start if hop.up else hop.end
    edge = source.edge(child, hop.link)
    near, far = ("child", "parent") if hop.up else ("parent", "child")
    return edge.select(F.col(near).alias("near"), F.col(far).alias("far"))


def upward(source: GraphSource, hops: list[Hop]) -> DataFrame:
    """(near, which, far): the pairs of several hops up from one node type, ``which`` being a hop's number."""
    out = None
    for i, hop in enumerate(hops):
        step = pairs(source, hop).withColumn("which", F.lit(i))
        out = step if out is None else out.unionByName(step)
    return out


def shown(df: DataFrame, key: str) -> Column:
    """An id as documents show it: bytes in hexadecimal."""
    return F.hex(key) if dict(df.dtypes)[key] == "binary" else F.col(key)


def chain(source: GraphSource, hops: Iterable[Hop]) -> DataFrame:
    """(near, far) over a path, a row for each way along it.  Nodes on the way aren't read."""
    out = None
    for hop in hops:
        step = pairs(source, hop)
        out = step if out is None else out.join(step.select(F.col("near").alias("far"), F.col("far").alias("_next")), "far").select("near", F.col("_next").alias("far"))
    return out


def node(source: GraphSource, label: str, props: Iterable[str], key: str) -> DataFrame:
    """A node's properties with its id under another name."""
    return source.node(label, props).withColumnRenamed(id_column(label), key)


def among(df: DataFrame, keys: DataFrame | None) -> DataFrame:
    """``df`` with those ``near`` that are in ``keys`` (near); all of it without keys."""
    return df if keys is None else df.join(keys, "near", "left_semi")


def reach(source: GraphSource, hops: tuple[Hop, ...], props: Iterable[str], keys: DataFrame | None = None) -> DataFrame:
    """(near, far, _src_<property> for each): the nodes at the end of a path with raw properties, from ``keys`` on if they are given.

    A source that keeps the link to a parent in the child's own row (``child_rows``)
    gives both at once; otherwise the link table is joined with the node's.
    """
    *before, last = hops
    own = ("id", id_column(last.end))
    wanted = [p for p in dict.fromkeys(props) if p not in own]
    if not last.up and wanted and hasattr(source, "child_rows"):
        df = source.child_rows(last.end, last.link, wanted)
        df = df.select(F.col("parent").alias("near"), F.col("child").alias("far"), *[F.col(p).alias(f"_src_{p}") for p in wanted])
    else:
        df = pairs(source, last)
        if wanted:
            df = df.join(node(source, last.end, wanted, "far").select("far", *[F.col(p).alias(f"_src_{p}") for p in wanted]), "far")
    if not before:
        df = among(df, keys)
    else:
        way = among(chain(source, before), keys)
        df = way.join(df.withColumnRenamed("near", "_way"), way["far"] == F.col("_way")).drop(way["far"]).drop("_way")
    return df.withColumns({f"_src_{p}": shown(df, "far") for p in own})
