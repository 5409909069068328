"""A star schema of Parquet tables seen as a property graph."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import GraphModel, Link, ModelError, Node, Property, id_column

_KIND = {"string": "string", "bigint": "integer", "int": "integer", "double": "number", "timestamp": "string"}

#: Columns of the tables and their types.
TABLES = {
    "region": {"r_regionkey": "int", "r_name": "string"},
    "nation": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
    "customer": {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"},
    "supplier": {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"},
    "part": {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int", "p_retailprice": "double"},
    "orders": {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": "timestamp", "o_orderpriority": "string"},
    "lineitem": {
        "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double", "l_extendedprice": "double",
        "l_discount": "double", "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp",
    },
    "events": {"event_id": "bigint", "ts": "timestamp", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string"},
    "documents": {"doc_id": "bigint", "lang": "string", "source": "string", "n_chars": "bigint"},
    "labels": {"doc_id": "bigint", "quality": "int", "toxic": "int"},
}

#: label: (table, category, key columns, {link: (parent, backref, foreign key, multiplicity)})
NODES: dict[str, tuple[str, str, tuple[str, ...], dict[str, tuple[str, str, str, str]]]] = {
    "program": ("region", "administrative", ("r_regionkey",), {}),
    "project": ("nation", "administrative", ("n_nationkey",), {"programs": ("program", "projects", "n_regionkey", "many_to_one")}),
    "subject": ("customer", "clinical", ("c_custkey",), {"projects": ("project", "subjects", "c_nationkey", "many_to_one")}),
    "vendor": ("supplier", "clinical", ("s_suppkey",), {"projects": ("project", "vendors", "s_nationkey", "many_to_one")}),
    "item": ("part", "reference", ("p_partkey",), {}),
    "sample": ("orders", "biospecimen", ("o_orderkey",), {"subjects": ("subject", "samples", "o_custkey", "many_to_one")}),
    "aliquot": (
        "lineitem", "data_file", tuple(TABLES["lineitem"]),
        {
            "samples": ("sample", "aliquots", "l_orderkey", "many_to_one"),
            "vendors": ("vendor", "aliquots", "l_suppkey", "many_to_one"),
            "items": ("item", "aliquots", "l_partkey", "many_to_one"),
        },
    ),
    "visit": ("events", "data_file", ("event_id",), {"subjects": ("subject", "visits", "user_id", "many_to_one")}),
    "document": ("documents", "text", ("doc_id",), {}),
    "label": ("labels", "text", ("doc_id",), {"documents": ("document", "labels", "doc_id", "one_to_one")}),
}
#: Names that collectors look for.
_ALIAS = {"program": {"name": "r_name"}, "project": {"code": "n_name"}}


def model() -> GraphModel:
    nodes = []
    for label, (table, category, _, links) in NODES.items():
        props = {c: Property((_KIND[k],)) for c, k in TABLES[table].items()}
        props |= {a: props[c] for a, c in _ALIAS.get(label, {}).items()}
        found = tuple(Link(name, parent, backref, f"{label}.{name}", many) for name, (parent, backref, _, many) in links.items())
        nodes.append(Node(label, category, props, found))
    return GraphModel(nodes)


class RelationalSource:
    """Node tables are tables, edges their foreign keys.  A table without a key is identified by 128 bits of hash of all its columns."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir, self.model = spark, sf_dir.rstrip("/"), model()

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _key(self, label: str) -> Column:
        keys = NODES[label][2]
        if len(keys) == 1:
            return F.col(keys[0])
        parts = [x for k in keys for x in (F.col(k), F.col(k).isNull())]  # hashes skip nulls, so these are marked
        return F.unhex(F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(n), *parts)), 16, "0") for n in range(2)]))

    def _props(self, label: str, df: DataFrame, props: Iterable[str]) -> list[Column]:
        alias = _ALIAS.get(label, {})
        wanted = [p for p in dict.fromkeys(props) if p not in ("id", id_column(label))]
        return [(F.col(alias.get(p, p)) if alias.get(p, p) in df.columns else F.lit(None).cast("string")).alias(p) for p in wanted]

    def node(self, label: str, props: Iterable[str]) -> DataFrame:
        if label not in NODES:
            raise ModelError(f"no table for {label}")
        df = self.table(NODES[label][0])
        return df.select(self._key(label).alias(id_column(label)), *self._props(label, df, props))

    def edge(self, child: str, link: Link) -> DataFrame:
        return self.child_rows(child, link, ())

    def one_row(self, child: str) -> bool:
        """Whether a node is one row of its table, which holds its links."""
        return len(NODES[child][2]) == 1

    def node_with_links(self, label: str, props: Iterable[str], links: Iterable[Link]) -> DataFrame:
        """``node`` with the parent's id of each of these links as ``_up_<link>``, null where there is none."""
        table, _, _, of = NODES[label]
        df = self.table(table)
        return df.select(self._key(label).alias(id_column(label)), *self._props(label, df, props), *[F.col(of[x.name][2]).alias(f"_up_{x.name}") for x in links])

    def child_rows(self, child: str, link: Link, props: Iterable[str]) -> DataFrame:
        """(child, parent, properties of the child): a foreign key stands in the child's row, so nothing is joined."""
        table, _, _, links = NODES[child]
        df = self.table(table)
        rows = df.select(self._key(child).alias("child"), F.col(links[link.name][2]).alias("parent"), *self._props(child, df, props))
        return rows.where("parent is not null")
