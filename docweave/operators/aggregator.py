"""One document for each root node.

Every branch (a parent path, a flattened child, the aggregated paths below a
first link, a nested block) is reduced to one row for each root before it is
joined, so branches never multiply each other.  Paths that share a prefix are
reduced together, level by level from the leaves.  Counts are taken from edges;
a child's table is read only if one of its properties is asked for.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as E
from ..functions.types import reduced_type, spark_type
from ..mapping import Aggregate, Combined, Condition, Document, Flatten, MappingError, Nested, ParentPath, Prop, parse_path
from ..model import Hop, id_column
from ..sources.graph import GraphSource
from .hot import collected
from .sliding import sliding_window
from .walk import among, chain, node, pairs, reach, shown

KEY = "_key"
#: Category of the nodes of which there are few, each with a large share of all rows below it.
FEW = "administrative"


@dataclass
class Branch:
    """A node of the trie of aggregated paths: what is reduced here, and what lies below."""

    hop: Hop
    props: list[Prop] = field(default_factory=list)
    picks: dict[str, Flatten] = field(default_factory=dict)
    below: dict[str, Branch] = field(default_factory=dict)

    def names(self) -> list[Prop]:
        return self.props + [p for b in self.below.values() for p in b.names()]

    def all_picks(self) -> dict[str, Flatten]:
        """Children to pick here and below, by the column that holds them."""
        out = dict(self.picks)
        for b in self.below.values():
            out |= b.all_picks()
        return out


def trie(source: GraphSource, root: str, aggregates: tuple[Aggregate, ...], picks: Mapping[str, Flatten] | None = None) -> dict[str, Branch]:
    """Paths of aggregates and of children that are picked by a sort order, those with a common start together."""
    top: dict[str, Branch] = {}

    def end(path: str) -> Branch:
        at, branch = top, None
        for name, hop in zip(path.split("."), source.model.path(root, path), strict=True):
            branch = at.setdefault(name.strip(), Branch(hop))
            at = branch.below
        return branch

    for a in aggregates:
        end(a.path).props.append(a.prop)
    for name, spec in (picks or {}).items():
        end(spec.path).picks[name] = spec
    return top


def _only_counted(p: Prop, label: str) -> bool:
    return p.fn == "count" and p.src in ("", "id", id_column(label))


def reduce_branch(source: GraphSource, branch: Branch, keys: DataFrame | None = None) -> DataFrame:
    """(near, one column for each property in and below the branch), for the nodes in ``keys`` (near) if they are given."""
    label = branch.hop.end
    read = [p.src for p in branch.props if not _only_counted(p, label)]
    for spec in branch.picks.values():
        read += [p.src for p in spec.props] + [spec.sort]
    out = reach(source, (branch.hop,), read, keys) if read else among(pairs(source, branch.hop), keys)
    inner = None if keys is None else out.select(F.col("far").alias("near"))
    for below in branch.below.values():
        out = out.join(reduce_branch(source, below, inner).withColumnRenamed("near", "far"), "far", "left")
    exprs: list[Column] = []
    for p in branch.props:
        if _only_counted(p, label):  # a pair always has both ids, so none of them is needed
            exprs.append(F.count(F.lit(1)).alias(p.name))
            continue
        value, array = F.col(f"_src_{p.src}"), source.model.property(label, p.src).is_array
        value = E.recoded(value, p.values) if not array else value
        exprs.append(E.reduce_values(p.fn, value, array).alias(p.name))
    for name, spec in branch.picks.items():
        row = F.struct(F.col(f"_src_{spec.sort}").alias("_sort"), F.col("far").alias("_far"), *_renamed(spec.props))
        exprs.append(_extreme(spec, row).alias(name))
    for b in branch.below.values():
        exprs += [_extreme(spec, F.col(name)).alias(name) for name, spec in b.all_picks().items()]
    exprs += [E.merge_partials(p.fn, F.col(p.name)).alias(p.name) for b in branch.below.values() for p in b.names()]
    return out.groupBy("near").agg(*exprs)


def _extreme(spec: Flatten, row: Column) -> Column:
    return F.max(row) if spec.descending else F.min(row)


def _one_row(source: GraphSource, *labels: str) -> bool:
    """Whether these nodes are rows that hold their links, so that each has one parent of a kind at most."""
    return hasattr(source, "node_with_links") and all(map(source.one_row, labels))


def _hops_of(source: GraphSource, root: str, path: ParentPath) -> list[Hop]:
    out, label = [], root
    for step in path.steps:
        out.append(source.model.resolve(label, step.link))
        label = out[-1].end
    return out


def ancestors(source: GraphSource, hops: list[Hop], path: ParentPath, first: int = 0) -> DataFrame:
    """(far, properties of it and of what is above): each table read once for its properties and its link."""
    label, props = hops[first].end, path.steps[first].props
    own = ("id", id_column(label))
    more = hops[first + 1 :][:1]
    df = source.node_with_links(label, [p.src for p in props], [h.link for h in more]).withColumnRenamed(id_column(label), "far")
    taken = [E.taken(p, shown(df, "far") if p.src in own else F.col(p.src)) for p in props]
    df = df.select("far", *taken, *[f"_up_{h.link.name}" for h in more])
    if not more:
        return df
    up = f"_up_{more[0].link.name}"
    return df.join(ancestors(source, hops, path, first + 1).withColumnRenamed("far", up), up).drop(up)


def single_parents(source: GraphSource, df: DataFrame, root: str, path: ParentPath, hops: list[Hop]) -> DataFrame:
    """As ``parent_branch`` for ``df`` with the first link's parent as ``_up_<link>``: one join with one row of ancestors, no reduction."""
    up = f"_up_{hops[0].link.name}"
    names = [(p, h.end) for s, h in zip(path.steps, hops, strict=True) for p in s.props]
    above = ancestors(source, hops, path).withColumnRenamed("far", up)
    if not path.single:
        for p, label in names:
            array = source.model.property(label, p.src).is_array
            one = F.sort_array(F.array_distinct(p.name)) if array else F.array(p.name)
            above = above.withColumn(p.name, F.when(F.col(p.name).isNull(), F.array()).otherwise(one))
    return df.join(above, up, "left")


def parent_branch(source: GraphSource, root: str, path: ParentPath) -> DataFrame | None:
    """(near, properties of ancestors): sets over all ways up, or one value for a single parent."""
    label, out, names = root, None, []
    for step in path.steps:
        hop = source.model.resolve(label, step.link)
        label, edge = hop.end, pairs(source, hop)
        if out is None:
            out = edge
        else:
            out = out.join(edge.select(F.col("near").alias("far"), F.col("far").alias("_next")), "far").drop("far").withColumnRenamed("_next", "far")
        if step.props:
            out = out.join(_projected(source, label, step.props, "far"), "far")
            names += [(p, label) for p in step.props]
    if not names:
        return None
    fn = "first" if path.single else "set"
    out = out.groupBy("near")
    return out.agg(*[E.reduce_values(fn, F.col(p.name), source.model.property(label, p.src).is_array and not path.single).alias(p.name) for p, label in names])


def _projected(source: GraphSource, label: str, props: tuple[Prop, ...], key: str, up: Iterable[Hop] = ()) -> DataFrame:
    """Renamed and recoded properties of a node with its id as ``key``, and the parent's id of each hop ``up`` as ``_up_<link>``."""
    links = {h.link.name: h.link for h in up}
    read = [p.src for p in props]
    df = source.node_with_links(label, read, links.values()).withColumnRenamed(id_column(label), key) if links else node(source, label, read, key)
    own = ("id", id_column(label))
    return df.select(key, *[f"_up_{name}" for name in links], *[E.taken(p, shown(df, key) if p.src in own else F.col(p.src)) for p in props])


def _renamed(props: tuple[Prop, ...]) -> list[Column]:
    """Properties out of what ``reach`` gives."""
    return [E.taken(p, F.col(f"_src_{p.src}")) for p in dict.fromkeys(props)]


def flatten_branch(source: GraphSource, root: str, spec: Flatten, bypass: bool = False) -> DataFrame:
    """(near, properties of a child): the first by a sort order, reduced ones, or those of the only child.

    Equal sort keys are decided by the other properties and the child's id.  Null
    sort keys come first in ascending and last in descending order.
    """
    hops = source.model.path(root, spec.path)
    label = hops[-1].end
    reduced = [p for p in spec.props if p.fn]
    df = reach(source, hops, [p.src for p in spec.props] + ([spec.sort] if spec.sort else []))
    sort = [F.col(f"_src_{spec.sort}").alias("_sort")] if spec.sort else []
    df = df.select("near", "far", *sort, *_renamed(spec.props))
    if spec.sort:
        row = F.struct("_sort", "far", *[p.name for p in spec.props])
        return df.groupBy("near").agg(_extreme(spec, row).alias("top")).select("near", *[F.col(f"top.{p.name}").alias(p.name) for p in spec.props])
    if reduced and len(reduced) == len(spec.props):
        return df.groupBy("near").agg(*[E.reduce_values(p.fn, F.col(p.name), source.model.property(label, p.src).is_array).alias(p.name) for p in spec.props])
    single = all(h.up or h.link.one_child or h.link.multiplicity == "one_to_many" for h in hops)
    if not single and not bypass:
        raise MappingError(f"{spec.path} may lead from one {root} to many {label}; give sorted_by or fn")
    return df.drop("far")


def _spread(source: GraphSource, parent: str, spec: Nested) -> bool:
    """Whether a parent's children are collected in parts: if the block says so, else where parents are few and large, as programs and projects are."""
    return spec.spread if spec.spread is not None else source.model[parent].category == FEW


def nested_branch(source: GraphSource, parent: str, spec: Nested, keys: DataFrame | None = None) -> DataFrame:
    """(near, one array of child documents under the block's name); children are filtered before."""
    hops = source.model.path(parent, spec.path)
    label = hops[-1].end
    wanted = {p.name for p in spec.props}
    props = (*spec.props, *(Prop(c.prop, c.prop) for c in E.filtered_props(spec.filter) if c.prop not in wanted))
    df = reach(source, hops, [p.src for p in props], keys).select("near", "far", *_renamed(props))
    below = None if keys is None else df.select(F.col("far").alias("near"))
    inner = _blocks(spec.nested)
    for block in inner:
        df = df.join(nested_branch(source, label, block, below).withColumnRenamed("near", "far"), "far", "left")
    if spec.filter is not None:
        df = df.where(E.predicate(spec.filter, F.col))
    row = F.struct(*[p.name for p in spec.props], *[b.name for b in inner])
    if _spread(source, parent, spec):
        return collected(df, "near", "far", row, spec.name)
    return df.groupBy("near").agg(F.sort_array(F.collect_list(row)).alias(spec.name))


def _blocks(blocks: tuple[Nested, ...]) -> list[Nested]:
    """Blocks with a path; those that only group others are replaced by them."""
    return [x for b in blocks for x in ([b] if b.path else _blocks(b.nested))]


def _implied(doc: Document, known: set[str]) -> tuple[Aggregate, ...]:
    """Sets that a filter asks for by ``path__property``."""
    out = {}
    for c in E.filtered_props(doc.filter):
        if c.prop not in known and "__" in c.prop:
            path, _, src = c.prop.rpartition("__")
            out[c.prop] = Aggregate(path.replace("__", "."), Prop(c.prop, src, "set"))
    return tuple(out.values())


def _root_props(source: GraphSource, doc: Document) -> tuple[Prop, ...]:
    """A project root always shows its code."""
    props = doc.props
    if doc.root == "project" and "code" in source.model[doc.root].properties and not any(p.name == "project_code" for p in props):
        props = (*props, Prop("project_code", "code"))
    return props


def _root_parents(source: GraphSource, doc: Document) -> tuple[ParentPath, ...]:
    """A project root always shows its program's name."""
    if doc.root != "project" or any(p.name == "program_name" for path in doc.parents for s in path.steps for p in s.props):
        return doc.parents
    names = {h.link.name for h in source.model.up("project")}
    return (*doc.parents, ParentPath(parse_path("programs[program_name:name]"), True)) if "programs" in names else doc.parents


def conjuncts(node: Condition | Combined | None) -> list[Condition | Combined]:
    """Parts of a filter that must all hold."""
    if node is None:
        return []
    return [x for p in node.parts for x in conjuncts(p)] if isinstance(node, Combined) and node.op == "and" else [node]


def compile_aggregator(source: GraphSource, doc: Document, bypass_multiplicity: bool = False, selective: bool = False, kept: list[DataFrame] | None = None) -> DataFrame:
    """The document's rows before joins with other documents and the filter: ``_<doc_type>_id`` and its columns.

    With ``selective``, what the filter says of the root and of aggregates is found first, and all other
    branches start from the roots that are left, at each of their hops; worth it where few are.  These roots' ids are persisted and
    added to ``kept`` if that is given, and are an exchange that is used again otherwise.
    """
    root = doc.root
    parents = [(path, _hops_of(source, root, path)) for path in _root_parents(source, doc)]
    near = [(path, hops) for path, hops in parents if _one_row(source, root, *[h.end for h in hops]) and all(h.up for h in hops)]
    df = _projected(source, root, _root_props(source, doc), KEY, [hops[0] for _, hops in near])

    def attach(branch: DataFrame) -> None:
        nonlocal df
        clash = E.kept([c for c in branch.columns if c != "near"], df.columns, doc.name)
        df = df.join(branch.drop(*clash).withColumnRenamed("near", KEY), KEY, "left")

    for path, hops in parents:
        names = [p.name for s in path.steps for p in s.props]
        if (path, hops) in near:
            if names and not set(names) & set(df.columns) and len(set(names)) == len(names):
                df = single_parents(source, df, root, path, hops)
                continue
        if (branch := parent_branch(source, root, path)) is not None:
            attach(branch)
    df = df.drop(*[c for c in df.columns if c.startswith("_up_")])
    picks: dict[str, Flatten] = {}
    for spec in doc.flatten:
        if spec.sort:  # reduced with the aggregates, as its table is then read once
            names = [p.name for p in spec.props]
            clash = E.kept(names, [*df.columns, *[p.name for x in picks.values() for p in x.props]], doc.name)
            picks[f"_pick_{len(picks)}"] = replace(spec, props=tuple(p for p in spec.props if p.name not in clash))
            continue
        attach(flatten_branch(source, root, spec, bypass_multiplicity))
    picked = [F.col(f"{name}.{p.name}").alias(p.name) for name, spec in picks.items() for p in spec.props]
    if "project_id" not in df.columns and {"program_name", "project_code"} <= set(df.columns):
        df = df.withColumn("project_id", E.project_id(F.col("program_name"), F.col("project_code")))
    before = df.columns
    known = [*df.columns, *[p.name for spec in picks.values() for p in spec.props]]
    implied = _implied(doc, set(known) | {a.prop.name for a in doc.aggregates})
    aggregates = doc.aggregates + implied
    if clash := E.kept([a.prop.name for a in aggregates if picks], known, doc.name):
        aggregates = tuple(a for a in aggregates if a.prop.name not in clash)
    branches, keys = trie(source, root, aggregates, picks), None
    if selective:
        of = {a.prop.name: a for a in aggregates}
        asked = {c.prop for c in E.filtered_props(doc.filter)}
        first = [n for n, b in branches.items() if asked & {p.name for p in b.names()} and not b.all_picks()]
        for name in first:
            branch = branches[name]
            attach(reduce_branch(source, branch))
            df = df.withColumns({p.name: E.completed(p.fn, F.col(p.name)) for p in branch.names() if p.name in of})
        parts = [p for p in conjuncts(doc.filter) if {c.prop for c in E.filtered_props(p)} <= set(df.columns)]
        if parts:
            df = df.where(E.predicate(Combined("and", tuple(parts)), F.col))
            keys = df.select(F.col(KEY).alias("near"))
            if kept is not None:
                keys = keys.persist()
                kept.append(keys)
    for branch in branches.values():
        if not {p.name for p in branch.names()} & set(df.columns) or branch.all_picks():
            attach(reduce_branch(source, branch, keys))
    df = df.select(*before, *picked, *[p.name for b in branches.values() for p in b.names()])
    if picks:
        if "project_id" not in df.columns and {"program_name", "project_code"} <= set(df.columns):
            df = df.withColumn("project_id", E.project_id(F.col("program_name"), F.col("project_code")))
    for a in aggregates:
        df = df.withColumn(a.prop.name, E.completed(a.prop.fn, F.col(a.prop.name)))
    for s in doc.sliding:
        hops = source.model.path(root, s.path)
        rows = among(chain(source, hops), keys).join(node(source, hops[-1].end, [s.offset, s.value], "far"), "far")
        attach(sliding_window(rows, "near", s.offset, s.value, s.size, s.fn, s.over, s.name))
    for block in _blocks(doc.nested):
        attach(nested_branch(source, root, block, keys))
    return df.withColumn(KEY, shown(df, KEY)).withColumnRenamed(KEY, id_column(doc.doc_type))


def finish(source: GraphSource, doc: Document, df: DataFrame) -> DataFrame:
    """Apply the document's filter, and drop what was computed for it only."""
    if doc.filter is None:
        return df
    unknown = [c.prop for c in E.filtered_props(doc.filter) if c.prop.split(".")[0] not in df.columns]
    if unknown:
        raise MappingError(f"{doc.name}: the filter asks for {', '.join(unknown)}, which the document lacks")
    own = {a.prop.name for a in doc.aggregates}
    extra = [a.prop.name for a in _implied(doc, own | {p.name for p in doc.props}) if a.prop.name in df.columns]
    return df.where(E.predicate(doc.filter, F.col)).drop(*extra)


def prop_types(source: GraphSource, doc: Document) -> dict[str, object]:
    """Spark types of the document's own properties, from the model alone."""
    m, out = source.model, {}
    for p in doc.props:
        out[p.name] = spark_type(m.property(doc.root, p.src)) if doc.root else None
    for a in doc.aggregates:
        out[a.prop.name] = reduced_type(a.prop.fn, m.property(m.path(doc.root, a.path)[-1].end, a.prop.src or "id"))
    return out


__all__ = ["Branch", "compile_aggregator", "finish", "flatten_branch", "nested_branch", "parent_branch", "prop_types", "reduce_branch", "trie"]
