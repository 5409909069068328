"""Mappings: which documents to build, from YAML or plain dictionaries."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

REDUCERS = ("count", "sum", "min", "max", "set", "list", "first")
OPERATORS = ("=", "==", "!=", "<>", "<", "<=", ">", ">=", "like", "in", "contains")


class MappingError(ValueError):
    """A mapping can't be understood."""


@dataclass(frozen=True)
class Prop:
    """An output column: taken from ``src``, recoded by ``values``, reduced by ``fn``."""

    name: str
    src: str
    fn: str | None = None
    values: Mapping[Any, Any] = field(default_factory=dict, hash=False)

    @classmethod
    def of(cls, spec: Mapping[str, Any] | str) -> Prop:
        if isinstance(spec, str):
            return cls(spec, spec)
        if not spec.get("name"):
            raise MappingError(f"a property needs a name: {dict(spec)!r}")
        fn = spec.get("fn")
        if fn is not None and fn not in REDUCERS:
            raise MappingError(f"unknown function {fn!r}; known: {', '.join(REDUCERS)}")
        values = spec.get("value_mappings") or {}
        if not isinstance(values, Mapping):
            values = {k: v for pair in values for k, v in pair.items()}
        return cls(spec["name"], spec.get("src", "" if fn == "count" and "src" not in spec else spec["name"]), fn, dict(values))


@dataclass(frozen=True)
class Step:
    """A link and the properties of the node it leads to."""

    link: str
    props: tuple[Prop, ...]


@dataclass(frozen=True)
class ParentPath:
    steps: tuple[Step, ...]
    single: bool = False


@dataclass(frozen=True)
class Flatten:
    path: str
    props: tuple[Prop, ...]
    sort: str | None = None
    descending: bool = False


@dataclass(frozen=True)
class Aggregate:
    path: str
    prop: Prop


@dataclass(frozen=True)
class Nested:
    """Child documents; without a path only a group of other blocks.

    ``spread`` says whether a parent's children are collected in parts first; None leaves it to the parent's category.
    """

    name: str
    path: str | None
    props: tuple[Prop, ...]
    nested: tuple[Nested, ...] = ()
    filter: Condition | Combined | None = None
    spread: bool | None = None


@dataclass(frozen=True)
class IndexJoin:
    index: str
    keys: tuple[str, ...]
    props: tuple[Prop, ...]


@dataclass(frozen=True)
class Sliding:
    """fn over every full window of ``size`` consecutive offsets of a child, then ``over`` these."""

    name: str
    path: str
    offset: str
    value: str
    size: int
    fn: str
    over: str


@dataclass(frozen=True)
class Condition:
    prop: str
    op: str
    value: Any


@dataclass(frozen=True)
class Combined:
    op: str
    parts: tuple[Condition | Combined, ...]


@dataclass(frozen=True)
class Document:
    """A mapping: ``root`` for one document per root node, ``category`` for one per collected leaf."""

    name: str
    doc_type: str
    kind: str
    root: str | None = None
    category: str | None = None
    props: tuple[Prop, ...] = ()
    parents: tuple[ParentPath, ...] = ()
    flatten: tuple[Flatten, ...] = ()
    aggregates: tuple[Aggregate, ...] = ()
    nested: tuple[Nested, ...] = ()
    joins: tuple[IndexJoin, ...] = ()
    sliding: tuple[Sliding, ...] = ()
    injected: Mapping[str, tuple[Prop, ...]] = field(default_factory=dict, hash=False)
    filter: Condition | Combined | None = None


def _props(specs: Any) -> tuple[Prop, ...]:
    return tuple(Prop.of(s) for s in specs or ())


def parse_filter(spec: Mapping[str, Any] | None) -> Condition | Combined | None:
    if not spec:
        return None
    op = str(spec.get("op", "")).strip().lower()
    if op in ("and", "or"):
        return Combined(op, tuple(p for s in spec.get("logics", ()) if (p := parse_filter(s))))
    if op not in OPERATORS:
        raise MappingError(f"unknown operator {spec.get('op')!r}")
    return Condition(spec["prop"], op, spec["value"])


_STEP = re.compile(r"\s*([A-Za-z_]\w*)\s*(?:\[([^\]]*)\])?\s*(\.|$)")


def parse_path(text: str) -> tuple[Step, ...]:
    """``link[a,b:c].link2[d]``: links with the properties to take, renamed as name:src."""
    steps, at = [], 0
    while at < len(text):
        m = _STEP.match(text, at)
        if not m or (m[3] == "." and m.end() == len(text)):
            raise MappingError(f"can't read path {text!r} from {text[at:]!r} on")
        names = [n.strip() for n in (m[2] or "").split(",") if n.strip()]
        steps.append(Step(m[1], tuple(Prop(a.strip(), (b or a).strip()) for a, _, b in (n.partition(":") for n in names))))
        at = m.end()
    if not steps:
        raise MappingError("empty path")
    return tuple(steps)


def _nested(spec: Mapping[str, Any]) -> Nested:
    path = spec.get("path")
    inner = tuple(_nested(s) for s in spec.get("nested_props") or ())
    if not path and (spec.get("props") or not inner):
        raise MappingError(f"nested block {spec.get('name')!r} needs a path")
    spread = spec.get("spread")
    if spread is not None and not isinstance(spread, bool):
        raise MappingError(f"spread of a nested block is true or false, not {spread!r}")
    return Nested(spec.get("name") or (path or "").replace(".", "_"), path, _props(spec.get("props")), inner, parse_filter(spec.get("filter")), spread)


def _flatten(spec: Mapping[str, Any]) -> Flatten:
    sort, _, order = str(spec.get("sorted_by") or "").partition(",")
    order = order.strip().lower()
    if order not in ("", "asc", "desc"):
        raise MappingError(f"unknown order {order!r}")
    return Flatten(spec["path"], _props(spec.get("props")), sort.strip() or None, order == "desc")


def _sliding(spec: Mapping[str, Any]) -> Sliding:
    fns = [f.strip() for f in spec["fn"].split(",")]
    if len(fns) != 2 or any(f not in ("sum", "min", "max", "count") for f in fns):
        raise MappingError(f"a sliding property needs two functions, not {spec['fn']!r}")
    return Sliding(spec["name"], spec["path"], spec["offset"], spec.get("src", spec["name"]), int(spec["size"]), *fns)


def _unique(doc: Document) -> Document:
    """The first definition of a name wins."""
    seen: set[str] = set()

    def first(props: tuple[Prop, ...]) -> tuple[Prop, ...]:
        return tuple(p for p in props if not (p.name in seen or seen.add(p.name)))

    return Document(
        **{
            **doc.__dict__,
            "props": first(doc.props),
            "parents": tuple(ParentPath(tuple(Step(s.link, first(s.props)) for s in p.steps), p.single) for p in doc.parents),
            "flatten": tuple(Flatten(f.path, first(f.props), f.sort, f.descending) for f in doc.flatten),
            "aggregates": tuple(a for a in doc.aggregates if first((a.prop,))),
        }
    )


def parse_mapping(spec: Mapping[str, Any]) -> Document:
    kind = spec.get("type")
    if kind not in ("aggregator", "collector"):
        raise MappingError(f"unknown mapping type {kind!r}")
    if kind == "aggregator" and not spec.get("root"):
        raise MappingError("an aggregator needs a root")
    aggregates = []
    for a in spec.get("aggregated_props") or ():
        prop = Prop.of(a)
        if prop.fn is None:
            prop = Prop(prop.name, prop.src, "set", prop.values)
        if not a.get("path"):
            raise MappingError(f"aggregated property {prop.name} needs a path")
        aggregates.append(Aggregate(a["path"], prop))
    joins = tuple(IndexJoin(j["index"], tuple(k.strip() for k in j["join_on"].split(",")), _props(j.get("props"))) for j in spec.get("joining_props") or spec.get("joining") or ())
    return _unique(
        Document(
            name=spec.get("name") or spec["doc_type"],
            doc_type=spec["doc_type"],
            kind=kind,
            root=spec.get("root"),
            category=spec.get("category", "data_file") if kind == "collector" else None,
            props=_props(spec.get("props")),
            parents=tuple(ParentPath(parse_path(p["path"]), str(p.get("relation", "")).replace(" ", "") in ("1-1", "one_to_one")) for p in spec.get("parent_props") or ()),
            flatten=tuple(_flatten(f) for f in spec.get("flatten_props") or ()),
            aggregates=tuple(aggregates),
            nested=tuple(_nested(n) for n in spec.get("nested_props") or ()),
            joins=joins,
            sliding=tuple(_sliding(s) for s in spec.get("special_props") or ()),
            injected={label: _props(s.get("props")) for label, s in (spec.get("injecting_props") or {}).items()},
            filter=parse_filter(spec.get("filter")),
        )
    )


def parse_mappings(config: Mapping[str, Any] | list[Any]) -> list[Document]:
    specs = config["mappings"] if isinstance(config, Mapping) else config
    docs = [parse_mapping(s) for s in specs]
    if len({d.doc_type for d in docs}) < len(docs):
        raise MappingError("two mappings share a doc_type")
    return docs


def load_mappings(path: str) -> list[Document]:
    """From a YAML file."""
    import yaml

    with open(path, encoding="utf-8") as f:
        return parse_mappings(yaml.safe_load(f))


def resource_paths(access: Mapping[str, Any] | None) -> dict[str, str]:
    """Access paths by project, out of a file of users and their rights.

    Projects of users give theirs by ``auth_id``; a ``user_project_to_resource``
    table under ``authz`` (or ``rbac``) overrules them.
    """
    out: dict[str, str] = {}
    for user in ((access or {}).get("users") or {}).values():
        projects = (user or {}).get("projects") or []
        for p in projects if isinstance(projects, list) else [projects]:
            if p.get("resource") and p.get("auth_id"):
                out[p["auth_id"]] = p["resource"]
    rights = (access or {}).get("authz") or (access or {}).get("rbac") or {}
    return out | dict(rights.get("user_project_to_resource") or {})


def load_resource_paths(path: str | None) -> dict[str, str]:
    """From a YAML file; none without one."""
    if not path:
        return {}
    import yaml

    with open(path, encoding="utf-8") as f:
        return resource_paths(yaml.safe_load(f))
