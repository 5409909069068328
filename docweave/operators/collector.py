"""One document for each leaf of a category, with what lies above it.

Lineage runs down from the programs: every node type keeps, for each node and
project, the sets of injected properties of all its ancestors.  Several parents
are a union, never a product.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as E
from ..functions.types import spark_type
from ..mapping import Document, MappingError, Prop
from ..model import Hop, id_column
from ..sources.graph import GraphSource
from .walk import node, pairs, shown, upward

TOP, PROJECT = "program", "project"


class Lineage:
    """(near, project_id, a sorted set for each injected property) by node type.

    Node types are worked out from the projects down, each once.  Where links stand in the node's own row, its table is
    read once for links and properties, and what lies above several links is merged in that row; elsewhere all links of
    a type are one join and one grouping.  With ``kept``, a type that several others hang below is persisted and added to it.
    """

    def __init__(self, source: GraphSource, doc: Document, kept: list[DataFrame] | None = None) -> None:
        self.source, self.model, self.injected, self.kept = source, source.model, doc.injected, kept
        self.names = [p.name for props in doc.injected.values() for p in props if p.name != "project_id"]
        self._known: dict[str, DataFrame | None] = {}
        below = [h.end for label in self.model.nodes for h in self.model.up(label)]
        self._shared = {label for label in below if below.count(label) > 1}

    def _own(self, label: str) -> tuple[Prop, ...]:
        return tuple(p for p in self.injected.get(label, ()) if p.name != "project_id")

    def _wanted(self, label: str) -> list[str]:
        """Properties to read for what is injected."""
        return [p.src for p in self._own(label) if p.src not in ("id", id_column(label))]

    def _with_own(self, label: str, df: DataFrame) -> DataFrame:
        """Add a node's own injected properties, which ``df`` has as ``_src_<property>``, as sets."""
        for p in self._own(label):
            key = p.src in ("id", id_column(label))
            value = E.recoded(shown(df, "near") if key else F.col(f"_src_{p.src}"), p.values)
            array = not key and self.model.property(label, p.src).is_array
            one = F.coalesce(value, F.array()) if array else F.when(value.isNotNull(), F.array(value)).otherwise(F.array())
            df = df.withColumn(p.name, one if p.name not in df.columns else F.sort_array(F.array_union(p.name, one)))
        return df

    def _read(self, label: str, hop: Hop, read: list[str]) -> DataFrame:
        """(near, far, _src_<property>) where a node is one row that holds its link."""
        rows = self.source.child_rows(label, hop.link, read)
        return rows.select(F.col("child").alias("near"), F.col("parent").alias("far"), *[F.col(p).alias(f"_src_{p}") for p in dict.fromkeys(read)])

    def _joined(self, label: str, df: DataFrame, read: list[str]) -> DataFrame:
        """``df`` with raw properties of its nodes."""
        if not read:
            return df
        own = node(self.source, label, read, "near")
        return df.join(own.select("near", *[F.col(p).alias(f"_src_{p}") for p in dict.fromkeys(read)]), "near")

    def of(self, label: str, leaf: Iterable[str] = ()) -> DataFrame | None:
        """None for a node type that no project is above of.  ``leaf`` are properties that come along as ``_src_<property>``."""
        if label in self._known and not leaf:
            return self._known[label]
        read = list(dict.fromkeys([*self._wanted(label), *leaf]))
        df = self._project(read) if label == PROJECT else self._merged(label, read)
        if df is not None:
            df = self._with_own(label, df).drop(*[f"_src_{p}" for p in read if p not in leaf])
        if leaf:
            return df
        if df is not None and self.kept is not None and label in self._shared:
            df = df.persist()
            self.kept.append(df)
        self._known[label] = df
        return df

    def _merged(self, label: str, read: list[str]) -> DataFrame | None:
        found = [(h, above) for h in self.model.up(label) if self.model.reaches(h.end, PROJECT) and (above := self.of(h.end)) is not None]
        if not found:
            return None
        if len(found) == 1:
            hop, above = found[0]
            above = above.withColumnRenamed("near", "far")
            if hasattr(self.source, "child_rows") and self.source.one_row(label):
                return self._read(label, hop, read).join(above, "far").drop("far")
            df = pairs(self.source, hop).join(above, "far").drop("far")
        elif hasattr(self.source, "node_with_links"):
            return self._in_rows(label, found, read)
        else:
            above = None
            for i, (_, part) in enumerate(found):
                part = part.withColumnRenamed("near", "far").withColumn("which", F.lit(i))
                above = part if above is None else above.unionByName(part, allowMissingColumns=True)
            df = upward(self.source, [h for h, _ in found]).join(above, ["which", "far"]).drop("which", "far")
        sets = [c for c in df.columns if c not in ("near", "project_id")]
        merge: list[Column] = [E.united(F.col(c)).alias(c) for c in sets]
        df = df.repartition("near") if read else df  # for the join that follows, so that rows are dealt out once
        df = df.groupBy("near", "project_id").agg(*merge) if merge else df.distinct()
        return self._joined(label, df, read)

    def _in_rows(self, label: str, found: list[tuple[Hop, DataFrame]], read: list[str]) -> DataFrame:
        """What lies above several links that stand in the node's row: each row is joined with one row for each link and merged by itself.

        Equal rows of a table without a key are one node.
        """
        links = [h.link for h, _ in found]
        raw = {p: f"_src_{p}" for p in read}
        df = self.source.node_with_links(label, read, links).withColumnRenamed(id_column(label), "near").withColumnsRenamed(raw)
        if not self.source.one_row(label):
            df = df.repartition("near").dropDuplicates(["near"])  # not before rows are dealt out, where few are equal
        types = {c: t for _, above in found for c, t in above.dtypes if c not in ("near", "project_id")}
        for i, (hop, above) in enumerate(found):
            have = [F.col(c) if c in above.columns else F.array().cast(t).alias(c) for c, t in types.items()]
            parents = above.groupBy(F.col("near").alias("far")).agg(F.collect_list(F.struct("project_id", *have)).alias(f"_above_{i}"))
            df = _linked(df, f"_up_{hop.link.name}", parents)
        every = F.concat(*[F.coalesce(f"_above_{i}", F.array()) for i in range(len(found))])
        df = df.select("near", *raw.values(), every.alias("_above"))

        def merged(project: Column) -> Column:
            same = F.filter("_above", lambda x: x["project_id"] == project)
            return F.struct(project.alias("project_id"), *[E.merged(same[c]).alias(c) for c in types])

        projects = F.array_distinct(F.col("_above")["project_id"])
        apart = F.size(projects) == F.size("_above")  # as they nearly always are; then nothing is merged
        return df.select("near", *raw.values(), F.inline(F.when(apart, F.col("_above")).otherwise(F.transform(projects, merged))))

    def _project(self, read: list[str]) -> DataFrame:
        hop = next((h for h in self.model.up(PROJECT) if h.end == TOP), None)
        if hop is None:
            raise MappingError("a collector needs projects below programs")
        top = node(self.source, TOP, ["name", *self._wanted(TOP)], "near").withColumnRenamed("name", "_program")
        raw = {p: f"_src_{p}" for p in self._wanted(TOP)}
        top = top.select("near", "_program", *[F.col("_program" if p == "name" else p).alias(s) for p, s in raw.items()])
        above = self._with_own(TOP, top).drop(*raw.values()).withColumnRenamed("near", "far")
        wanted, read = read, list(dict.fromkeys(["code", *read]))
        if hasattr(self.source, "child_rows") and self.source.one_row(PROJECT):
            df = self._read(PROJECT, hop, read).join(above, "far").drop("far")
        else:
            df = self._joined(PROJECT, pairs(self.source, hop).join(above, "far").drop("far"), read)
        return df.withColumn("project_id", E.project_id(F.col("_program"), F.col("_src_code"))).drop("_program", *([] if "code" in wanted else ["_src_code"]))


def _linked(df: DataFrame, up: str, parents: DataFrame) -> DataFrame:
    """``df`` left joined with ``parents`` (far, ...) on ``up``.  Rows without a parent are spread over all tasks by a key that matches nothing."""
    if dict(df.dtypes)[up] != "bigint":
        return df.join(parents.withColumnRenamed("far", up), up, "left").drop(up)
    df = df.withColumn("_key", F.coalesce(up, F.xxhash64("near")))
    return df.join(parents, (F.col("_key") == F.col("far")) & F.col(up).isNotNull(), "left").drop("_key", "far", up)


def compile_collector(source: GraphSource, doc: Document, kept: list[DataFrame] | None = None) -> DataFrame:
    """``_<doc_type>_id``, project_id, source_node, the properties, and the injected sets.

    Leaves without a project above are left out; a leaf under two projects gives
    two documents.  Properties that a node type lacks are null.
    """
    key, lineage, out = id_column(doc.doc_type), Lineage(source, doc, kept), None
    props = [p for p in doc.props if p.name not in ("source_node", "project_id")]
    labels = source.model.in_category(doc.category)
    if not labels:
        raise MappingError(f"no node type is in category {doc.category}")
    kinds = {p.name: next((spark_type(source.model[x].properties[p.src]) for x in labels if p.src in source.model[x].properties), spark_type(source.model.property(labels[0], p.src))) for p in props}
    for label in labels:
        read = [p.src for p in props if p.src in source.model[label].properties and p.src not in ("id", id_column(label))]
        rows = lineage.of(label, read)
        if rows is None:
            continue
        cols = []
        for p in props:
            own = p.src in ("id", id_column(label))
            has = own or p.src in source.model[label].properties
            value = E.recoded(shown(rows, "near") if own else F.col(f"_src_{p.src}"), p.values) if has else F.lit(None)
            cols.append(value.cast(kinds[p.name] if not p.values else "string").alias(p.name))
        over = [c for c in rows.columns if c not in {p.name for p in props} and not c.startswith("_src_") and c != "near"]
        rows = rows.select(shown(rows, "near").cast("string").alias(key), *over, F.lit(label).alias("source_node"), *cols)
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    if out is None:
        raise MappingError(f"no node type of category {doc.category} is below a project")
    sets = [n for n in dict.fromkeys(lineage.names) if n in out.columns]
    out = out.withColumns({n: F.coalesce(n, F.array()) for n in sets})
    wanted = [p.name for p in doc.props]
    extra = ["source_node"] if "source_node" in wanted else []
    return out.select(key, "project_id", *extra, *[p.name for p in props], *sets)
