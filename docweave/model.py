"""The property graph: node types, their properties and links, and how to walk along them."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from typing import Any

SCALARS = ("number", "integer", "boolean", "string")


class ModelError(ValueError):
    """A graph model or a path in it doesn't fit."""


def id_column(label: str) -> str:
    """Name of the column that identifies a node."""
    return f"_{label}_id"


@dataclass(frozen=True)
class Property:
    """Types in the order in which they are declared; ``items`` is the type of an array's items."""

    types: tuple[str, ...] = ("string",)
    items: str | None = None

    @property
    def is_array(self) -> bool:
        return self.types[0] == "array"

    @classmethod
    def of(cls, spec: Mapping[str, Any]) -> Property:
        """From JSON schema; of alternatives the first that is understood counts."""
        for key in ("anyOf", "oneOf"):
            for option in spec.get(key, ()):
                try:
                    return cls.of(option)
                except ModelError:
                    continue
        if key_types := spec.get("type"):
            names = [key_types] if isinstance(key_types, str) else list(key_types)
            known = tuple(t for t in names if t in SCALARS or t == "array")
            if known:
                items = cls.of(spec["items"]).types[0] if "array" in known and spec.get("items") else None
                return cls(known, items)
        elif "enum" in spec or "pattern" in spec:
            return cls()
        raise ModelError(f"no known type in {dict(spec)!r}")


@dataclass(frozen=True)
class Link:
    """A link from a child to a parent node type, by the name it has on either side."""

    name: str
    target: str
    backref: str
    edge: str
    multiplicity: str = "many_to_one"

    @property
    def one_child(self) -> bool:
        """Whether a parent has one child at most over this link."""
        return self.multiplicity == "one_to_one"


@dataclass(frozen=True)
class Node:
    label: str
    category: str = ""
    properties: Mapping[str, Property] = field(default_factory=dict)
    links: tuple[Link, ...] = ()


@dataclass(frozen=True)
class Hop:
    """One step of a path; ``up`` goes from a child to a parent."""

    edge: str
    start: str
    end: str
    up: bool
    link: Link


def edge_table(child: str, label: str, parent: str) -> str:
    return "edge_" + "".join(part.replace("_", "") for part in (child, label, parent))


def node_table(label: str) -> str:
    return "node_" + label.replace("_", "")


class GraphModel:
    """Node types by label; links must not form a cycle."""

    def __init__(self, nodes: list[Node]) -> None:
        self.nodes = {n.label: n for n in nodes}
        for n in nodes:
            for link in n.links:
                if link.target not in self.nodes:
                    raise ModelError(f"{n.label}.{link.name} leads to unknown node type {link.target}")
        self.order = self._ordered()

    def _ordered(self) -> list[str]:
        """Labels with parents before children."""
        done: dict[str, bool] = {}
        out: list[str] = []

        def visit(label: str) -> None:
            if done.get(label):
                return
            if label in done:
                raise ModelError(f"links around {label} form a cycle")
            done[label] = False
            for link in self.nodes[label].links:
                visit(link.target)
            done[label] = True
            out.append(label)

        for label in self.nodes:
            visit(label)
        return out

    @classmethod
    def from_dictionary(cls, schemas: Mapping[str, Mapping[str, Any]]) -> GraphModel:
        """From JSON schemas by node label, with ``category``, ``properties`` and ``links``."""
        nodes = []
        for label, schema in schemas.items():
            properties, links = {}, []
            for name, spec in schema.get("properties", {}).items():
                try:
                    properties[name] = Property.of(spec)
                except ModelError:
                    continue
            for spec in _flat(schema.get("links", ())):
                links.append(Link(spec["name"], spec["target_type"], spec["backref"], edge_table(label, spec.get("label", ""), spec["target_type"]), spec.get("multiplicity", "many_to_one")))
            nodes.append(Node(label, schema.get("category", ""), properties, tuple(links)))
        return cls(nodes)

    def __getitem__(self, label: str) -> Node:
        if label not in self.nodes:
            raise ModelError(f"unknown node type {label}")
        return self.nodes[label]

    def up(self, label: str) -> Iterator[Hop]:
        for link in self[label].links:
            yield Hop(link.edge, label, link.target, True, link)

    def down(self, label: str) -> Iterator[Hop]:
        for child in self.nodes.values():
            for link in child.links:
                if link.target == label:
                    yield Hop(link.edge, label, child.label, False, link)

    def resolve(self, label: str, name: str) -> Hop:
        """The hop that ``name`` means on a node: a link to a parent or the backref of a child's link."""
        found = [h for h in self.up(label) if h.link.name == name] + [h for h in self.down(label) if h.link.backref == name]
        if len(found) != 1:
            raise ModelError(f"{name!r} on {label} names {len(found)} links")
        return found[0]

    def path(self, label: str, names: str) -> tuple[Hop, ...]:
        """Hops of a dotted path."""
        hops: list[Hop] = []
        for name in names.split("."):
            hops.append(self.resolve(hops[-1].end if hops else label, name.strip()))
        return tuple(hops)

    def in_category(self, category: str) -> list[str]:
        return [label for label in self.order if self.nodes[label].category == category]

    def reaches(self, label: str, top: str) -> bool:
        """Whether links lead from ``label`` up to ``top``."""
        return label == top or any(self.reaches(h.end, top) for h in self.up(label))

    def property(self, label: str, name: str) -> Property:
        """A node's property; unknown ones count as strings."""
        return Property() if name == "id" else self[label].properties.get(name, Property())


def _flat(links: Any) -> Iterator[Mapping[str, Any]]:
    for spec in links:
        if "subgroup" in spec:
            yield from _flat(spec["subgroup"])
        else:
            yield spec
