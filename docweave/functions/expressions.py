"""Column expressions: reducers, predicates, recoding and resource paths.

All of them are built-in functions, so plans stay inside generated code.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..mapping import Combined, Condition, MappingError, Prop


def united(c: Column) -> Column:
    """Union of sorted arrays.  Equal arrays become one before the shuffle, so a buffer holds different ones only."""
    return merged(F.collect_set(c))


def merged(c: Column) -> Column:
    """Union of the sorted arrays in an array."""
    return F.sort_array(F.array_distinct(F.flatten(c)))


def _set(c: Column, array: bool) -> Column:
    return united(c) if array else F.sort_array(F.collect_set(c))


def _list(c: Column, array: bool) -> Column:
    return F.sort_array(F.flatten(F.collect_list(c)) if array else F.collect_list(c))


#: How values of a column become one value of a group.  Collections are sorted, so that reruns agree.
REDUCE: dict[str, Callable[[Column, bool], Column]] = {
    "count": lambda c, _: F.count(c),
    "sum": lambda c, _: F.sum(c),
    "min": lambda c, _: F.min(c),
    "max": lambda c, _: F.max(c),
    "first": lambda c, _: F.min(c),
    "set": _set,
    "list": _list,
}


def reduce_values(fn: str, c: Column, array: bool = False) -> Column:
    return REDUCE[fn](c, array)


def merge_partials(fn: str, c: Column) -> Column:
    """Reduce values that ``fn`` made further down: counts add up, collections become one array."""
    return F.sum(c) if fn == "count" else REDUCE[fn](c, True)


def completed(fn: str, c: Column) -> Column:
    """What a group without members has: 0 or an empty array; sums and extremes stay null."""
    if fn == "count":
        return F.coalesce(c, F.lit(0).cast("long"))
    return F.coalesce(c, F.array()) if fn in ("set", "list") else c


def recoded(c: Column, values: Mapping[Any, Any]) -> Column:
    """Values by a mapping; others stay as they are."""
    if not values:
        return c
    table = F.create_map(*[F.lit(str(x)) for pair in values.items() for x in pair])
    return F.coalesce(table[c.cast("string")], c.cast("string"))


def taken(prop: Prop, c: Column) -> Column:
    return recoded(c, prop.values).alias(prop.name)


def predicate(node: Condition | Combined, column: Callable[[str], Column]) -> Column:
    """A filter as one column; an empty conjunction holds, an empty disjunction doesn't."""
    if isinstance(node, Combined):
        out = F.lit(node.op == "and")
        for k, part in enumerate(node.parts):
            p = predicate(part, column)
            out = p if not k else (out & p if node.op == "and" else out | p)
        return out
    c, v = column(node.prop), node.value
    if node.op == "in":
        return c.isin([v] if isinstance(v, str) or not hasattr(v, "__iter__") else list(v))
    if node.op == "contains":
        return F.array_contains(c, v)
    if node.op == "like":
        return c.like(v)
    compare = {
        "=": c == v, "==": c == v, "!=": c != v, "<>": c != v, "<": c < v, "<=": c <= v, ">": c > v, ">=": c >= v,
    }
    if node.op not in compare:
        raise MappingError(f"unknown operator {node.op!r}")
    return compare[node.op]


def kept(new: Sequence[str], known: Sequence[str], where: str) -> list[str]:
    """Which of ``new`` are there already.  The earlier column stays, and a warning says so."""
    clash = [c for c in new if c in known]
    if clash:
        warnings.warn(f"{where}: {', '.join(clash)} is there already; the earlier one stays", stacklevel=3)
    return clash


def filtered_props(node: Condition | Combined | None) -> list[Condition]:
    if node is None:
        return []
    return [c for p in node.parts for c in filtered_props(p)] if isinstance(node, Combined) else [node]


def project_id(program: Column, project: Column) -> Column:
    """``program-project``; nulls are left out and arrays are flattened."""
    return F.concat_ws("-", program, project)


def resource_path(c: Column, overrides: Mapping[str, str] | None = None) -> Column:
    """Access path of a ``program-project``: empty if it is null or has no ``-``.

    ``overrides`` gives the path of a project by the part after the first ``-``.
    """
    at = F.instr(c, "-")
    program, project = F.substr(c, F.lit(1), at - 1), F.substr(c, at + 1)
    path = F.concat(F.lit("/programs/"), program, F.lit("/projects/"), project)
    if overrides:
        path = F.coalesce(F.create_map(*[F.lit(x) for pair in overrides.items() for x in pair])[project], path)
    return F.coalesce(F.when(at > 0, path), F.lit(""))


def resource_paths(c: Column, array: bool, overrides: Mapping[str, str] | None = None) -> Column:
    return F.transform(c, lambda p: resource_path(p, overrides)) if array else resource_path(c, overrides)
