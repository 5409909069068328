"""Joining documents with other documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as E
from ..mapping import Document, IndexJoin, MappingError
from ..model import id_column


def order(docs: list[Document]) -> list[Document]:
    """Documents so that each comes after those it joins."""
    by_name = {d.doc_type: d for d in docs} | {d.name: d for d in docs}
    done: dict[str, bool] = {}
    out: list[Document] = []

    def visit(d: Document) -> None:
        if done.get(d.doc_type):
            return
        if d.doc_type in done:
            raise MappingError(f"joins of {d.doc_type} lead back to it")
        done[d.doc_type] = False
        for j in d.joins:
            if j.index not in by_name:
                raise MappingError(f"{d.name} joins unknown index {j.index}")
            visit(by_name[j.index])
        done[d.doc_type] = True
        out.append(d)

    for d in docs:
        visit(d)
    return out


def _column(df: DataFrame, name: str, what: str) -> str:
    """A column by its name, or that of the document's id."""
    for found in (name, id_column(name.removesuffix("_id").lstrip("_"))):
        if found in df.columns:
            return found
    raise MappingError(f"{what} has no column {name}")


def join_index(df: DataFrame, other: DataFrame, spec: IndexJoin) -> DataFrame:
    """Left join with another document.

    With functions, the other side is reduced to one row for each key first;
    without, a row comes for each match.  A null key matches nothing.
    """
    left = {k: _column(df, k, "the document") for k in spec.keys}
    right = {k: _column(other, k, spec.index) for k in spec.keys}
    keys = [F.col(right[k]).alias(f"_join_{n}") for n, k in enumerate(spec.keys)]
    names = [f"_join_{n}" for n in range(len(keys))]
    reduced = [p for p in spec.props if p.fn]
    if reduced and len(reduced) < len(spec.props):
        raise MappingError(f"join with {spec.index}: all properties need a function, or none")
    array = dict(other.dtypes)
    if reduced:
        exprs = []
        for p in reduced:
            src = _column(other, p.src, spec.index) if p.src else right[spec.keys[0]]
            exprs.append(E.reduce_values(p.fn, E.recoded(F.col(src), p.values), array[src].startswith("array")).alias(p.name))
        side = other.select(*keys, "*").groupBy(*names).agg(*exprs)
    else:
        side = other.select(*keys, *[E.recoded(F.col(_column(other, p.src, spec.index)), p.values).alias(p.name) for p in spec.props if p.name not in spec.keys])
    side = side.drop(*E.kept([p.name for p in spec.props if p.name in side.columns], df.columns, f"join with {spec.index}"))
    on = [df[left[k]] == side[n] for k, n in zip(spec.keys, names, strict=True)]
    out = df.join(side, on, "left").drop(*names)
    done = [p for p in reduced if p.name in side.columns]
    return out.withColumns({p.name: E.completed(p.fn, F.col(p.name)) for p in done}) if done else out
