"""From mappings to frames: one lazy plan for each document."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as E
from ..mapping import Document
from ..operators.aggregator import compile_aggregator, finish
from ..operators.collector import compile_collector
from ..operators.index_join import join_index, order
from ..sources.graph import GraphSource

Plugin = Callable[[DataFrame], DataFrame]


def auth_plugin(overrides: Mapping[str, str] | None = None) -> Plugin:
    """Adds ``auth_resource_path`` where there is a ``project_id``."""

    def run(df: DataFrame) -> DataFrame:
        if "project_id" not in df.columns:
            return df
        array = dict(df.dtypes)["project_id"].startswith("array")
        return df.withColumn("auth_resource_path", E.resource_paths(F.col("project_id"), array, overrides))

    return run


def compile_document(source: GraphSource, doc: Document, others: Mapping[str, DataFrame] | None = None, bypass_multiplicity: bool = False, kept: list[DataFrame] | None = None, selective: bool = False) -> DataFrame:
    """The plan of one document; ``others`` holds those that it joins; for ``selective`` see ``compile_aggregator``."""
    df = compile_aggregator(source, doc, bypass_multiplicity, selective, kept) if doc.kind == "aggregator" else compile_collector(source, doc, kept)
    for spec in doc.joins:
        df = join_index(df, (others or {})[spec.index], spec)
    return finish(source, doc, df)


def compile_all(source: GraphSource, docs: list[Document], plugins: tuple[Plugin, ...] = (), bypass_multiplicity: bool = False, kept: list[DataFrame] | None = None, selective: bool = False) -> dict[str, DataFrame]:
    """Plans by doc_type, in the order of ``docs``.

    With ``kept``, what another document joins is persisted and added to it; the caller
    unpersists these when all is written.  Without, it is computed again where it is joined.
    """
    joined = {j.index for d in docs for j in d.joins}
    found: dict[str, DataFrame] = {}
    for d in order(docs):
        df = compile_document(source, d, found, bypass_multiplicity, kept, selective)
        if kept is not None and {d.name, d.doc_type} & joined:
            df = df.persist()
            kept.append(df)
        found[d.name] = found[d.doc_type] = df
    out = {}
    for d in docs:
        df = found[d.doc_type]
        for p in plugins:
            df = p(df)
        out[d.doc_type] = df
    return out


def trace(df: DataFrame, name: str, path: str | None) -> DataFrame:
    """Write a step's rows under ``path`` for comparison, if one is given, and go on from them."""
    if not path:
        return df
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")
    return df.sparkSession.read.parquet(f"{path.rstrip('/')}/{name}")
