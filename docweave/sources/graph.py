"""Node and edge tables of a graph: from text dumps, Parquet, a database, or frames.

``node`` gives the id column and the wanted properties; ``edge`` gives (child,
parent), each pair once.  Nothing is read before a plan runs, and only the wanted
columns are.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import SCALAR, node_schema, spark_type
from ..model import GraphModel, Link, ModelError, Property, id_column, node_table
from .database import DIALECTS, OTHER, Dialect, Moment, plan

#: Tables of the database that hold no nodes or edges (fixed values).
NOT_IMPORTED = ("transaction_documents", "transaction_logs", "transaction_snapshots", "_voided_edges", "_voided_nodes")

_DUMP_NODE = "created string, acl string, sysan string, props string, node_id string, _corrupt string"
_DUMP_EDGE = "created string, acl string, sysan string, props string, src_id string, dst_id string, _corrupt string"


class GraphSource(Protocol):
    model: GraphModel

    def node(self, label: str, props: Iterable[str]) -> DataFrame: ...

    def edge(self, child: str, link: Link) -> DataFrame: ...


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def _wanted(model: GraphModel, label: str, props: Iterable[str]) -> dict:
    return {p: model.property(label, p) for p in dict.fromkeys(props) if p not in ("id", id_column(label))}


#: What is done about records that can't be read: the query ends with an error that names one, or they are left out (``DumpSource.bad_records`` has them).
BAD = ("fail", "split")
_CORRUPT = "_corrupt"


def _decoded(wanted: Mapping[str, Property]) -> Column:
    """Properties out of JSON text, and the text itself if it isn't JSON or a value isn't of its property's type."""
    schema = node_schema(dict(wanted)).add(_CORRUPT, T.StringType())
    return F.from_json("props", schema, {"allowUnquotedControlChars": "true", "columnNameOfCorruptRecord": _CORRUPT})


def _checked(df: DataFrame, table: str, bad: str, good: Column, record: Column) -> DataFrame:
    """``df`` without rows that aren't good, or an error for the first of them."""
    if bad not in BAD:
        raise ValueError(f"bad records: {' or '.join(BAD)}, not {bad}")
    if bad == "split":
        return df.where(good)
    told = F.raise_error(F.concat(F.lit(f"bad record in {table}: "), F.coalesce(record, F.lit("null"))))
    return df.where(F.when(good, F.lit(True)).otherwise(told.cast("boolean")))


def _parsed(raw: DataFrame, model: GraphModel, label: str, props: Iterable[str], bad: str) -> DataFrame:
    """Id and properties out of (node_id, props as JSON text); records are checked as far as their properties are wanted."""
    wanted = _wanted(model, label, props)
    node = F.col("node_id").alias(id_column(label))
    if not wanted:
        return raw.select(node)
    rows = raw.select("node_id", "props", _decoded(wanted).alias("p"))
    rows = _checked(rows, node_table(label), bad, F.col(f"p.{_CORRUPT}").isNull(), F.concat_ws(" ", "node_id", "props"))
    return rows.select(node, "p.*").drop(_CORRUPT)


def _linked(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("src_id").alias("child"), F.col("dst_id").alias("parent")).where("child is not null and parent is not null")


def _pairs(raw: DataFrame) -> DataFrame:
    return _linked(raw).distinct()


class DumpSource:
    """Text dumps: a folder for each table, quoted CSV with doubled quotes, properties as JSON.

    Lines that can't be read, by their columns, their JSON, or the types of the properties that are asked for, end a query with an error that shows one
    (``bad="fail"``), or are left out (``"split"``); ``bad_records`` gives those of all tables with reasons.
    """

    def __init__(self, spark: SparkSession, path: str, model: GraphModel, bad: str = "fail") -> None:
        self.spark, self.path, self.model, self.bad = spark, path.rstrip("/"), model, bad

    def _read(self, table: str, schema: str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return empty(self.spark, schema)
        lines = self.spark.read.option("columnNameOfCorruptRecord", _CORRUPT).option("columnPruning", "false")  # else short lines aren't noticed
        return lines.csv(f"{self.path}/{table}", schema=schema, quote='"', escape='"', multiLine=False)

    def _lines(self, table: str, schema: str) -> DataFrame:
        rows = self._read(table, schema)
        return _checked(rows, table, self.bad, F.col(_CORRUPT).isNull(), F.col(_CORRUPT)).drop(_CORRUPT)

    def node(self, label: str, props: Iterable[str]) -> DataFrame:
        return _parsed(self._lines(node_table(label), _DUMP_NODE), self.model, label, props, self.bad)

    def edge(self, child: str, link: Link) -> DataFrame:
        return _pairs(self._lines(link.edge, _DUMP_EDGE))

    def some_edge(self, child: str, link: Link) -> DataFrame:
        return _linked(self._lines(link.edge, _DUMP_EDGE))

    def bad_records(self) -> DataFrame:
        """(table_name, id, reason, record) of every line that can't be read, of all tables and properties.

        Reasons: ``columns`` (a line isn't cut into the table's columns), ``properties`` (no JSON, or a value of another type than
        its property), ``id`` (none).
        """
        kinds = [(node_table(n.label), n) for n in self.model.nodes.values()] + [(link.edge, None) for n in self.model.nodes.values() for link in n.links]
        out = None
        for table, of in kinds:
            rows = self._read(table, _DUMP_NODE if of else _DUMP_EDGE)
            key, props, wrong = (F.col("node_id"), F.col("props"), _decoded(of.properties)[_CORRUPT].isNotNull()) if of else (F.concat_ws("/", "src_id", "dst_id"), F.lit(None), F.lit(False))
            lacks = F.col("node_id").isNull() if of else F.col("src_id").isNull() | F.col("dst_id").isNull()
            reason = F.when(F.col(_CORRUPT).isNotNull(), "columns").when(wrong, "properties").when(lacks, "id")
            found = rows.select(F.lit(table).alias("table_name"), key.cast("string").alias("id"), reason.alias("reason"), F.coalesce(_CORRUPT, props.cast("string")).alias("record"))
            out = found if out is None else out.unionByName(found)
        return out.where("reason is not null")

    def quarantine(self, path: str) -> dict[str, int]:
        """Write ``bad_records`` by table and reason below ``path``, in one job, and return how many each table has."""
        self.bad_records().write.mode("overwrite").partitionBy("table_name", "reason").parquet(path)
        found = self.spark.read.schema("id string, record string, table_name string, reason string").parquet(path)
        return {r[0]: r[1] for r in found.groupBy("table_name").count().collect()}


class JdbcSource:
    """Tables of a database, with columns node_id and _props, or src_id and dst_id.

    A table is read in up to ``partitions`` parts of about ``rows_per_part`` rows (``database.plan``).
    The statements follow the address's ``DIALECTS``, or ``dialect``; ``properties`` are the login and
    options of Spark's reader.  ``export`` reads all tables at one moment.
    """

    def __init__(
        self, spark: SparkSession, url: str, model: GraphModel, properties: Mapping[str, str] | None = None, partitions: int = 1,
        dialect: Dialect | None = None, rows_per_part: int = 1_000_000, bad: str = "fail",
    ) -> None:
        self.spark, self.url, self.model, self.properties, self.partitions = spark, url, model, dict(properties or {}), partitions
        self.dialect, self.rows_per_part, self.bad = dialect or DIALECTS.get(url.split(":")[1], OTHER), rows_per_part, bad

    def _query(self, statement: str) -> DataFrame:
        return self.spark.read.jdbc(self.url, f"({statement}) t", properties=self.properties)

    def parts(self, table: str, still: bool = False) -> list[str]:
        """Predicates of the parts that a table is read in; pairs are told apart by both ids, so that one id with many is no large part."""
        name = lambda c: self.dialect.quote + c + self.dialect.quote
        edge = table.startswith("edge_") or table in {link.edge for n in self.model.nodes.values() for link in n.links}
        key = f"{name('src_id')} || '/' || {name('dst_id')}" if edge else name("node_id")
        if edge and self.dialect.quote == "`":
            key = "concat(`src_id`, '/', `dst_id`)"
        return plan(lambda s: self._query(s).collect(), self.dialect, table, key, self.partitions, self.rows_per_part, still)

    def _read(self, table: str, more: Mapping[str, str] | None = None) -> DataFrame:
        return self.spark.read.jdbc(self.url, table, predicates=self.parts(table, bool(more)), properties=self.properties | dict(more or {}))

    def tables(self) -> list[str]:
        """Names of the tables to import."""
        found = self._query(self.dialect.tables).toDF("table_name")
        return [r[0] for r in found.where(~F.col("table_name").isin(*NOT_IMPORTED)).orderBy("table_name").collect()]

    def with_rows(self, tables: Iterable[str]) -> list[str]:
        """Those of ``tables`` that hold a row, asked in one statement."""
        some = [f"select '{t}' as table_name{self.dialect.one_row} where exists (select 1 from {t})" for t in tables]
        return sorted(r[0].strip() for r in self._query(" union all ".join(some)).toDF("table_name").collect()) if some else []

    def node(self, label: str, props: Iterable[str]) -> DataFrame:
        raw = self._read(node_table(label)).select("node_id", F.col("_props").cast("string").alias("props"))
        return _parsed(raw, self.model, label, props, self.bad)

    def edge(self, child: str, link: Link) -> DataFrame:
        return _pairs(self._read(link.edge))

    def export(self, path: str, tables: Iterable[str] | None = None, at_once: int = 4) -> dict[str, int]:
        """Copy tables, as they are at one moment, to Parquet folders that ``ParquetSource`` reads; their rows are returned.

        ``at_once`` tables are copied side by side, so that small ones don't leave the cluster idle.
        """
        tables = list(tables or self.tables())
        with Moment(self.spark, self.url, self.properties, self.dialect, tables) as seen, ThreadPoolExecutor(at_once) as pool:
            rows = list(pool.map(lambda t: self._copy(t, path, seen), tables))
        return dict(zip(tables, rows, strict=True))

    def _copy(self, table: str, path: str, seen: Mapping[str, str]) -> int:
        read = Observation()
        self._read(table, seen).observe(read, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{table}")
        return read.get["rows"]


class ParquetSource:
    """Parquet folders by table: nodes with node_id and either typed columns or _props; edges with src_id and dst_id."""

    def __init__(self, spark: SparkSession, path: str, model: GraphModel, bad: str = "fail") -> None:
        self.spark, self.path, self.model, self.bad = spark, path.rstrip("/"), model, bad

    def node(self, label: str, props: Iterable[str]) -> DataFrame:
        raw = self.spark.read.parquet(f"{self.path}/{node_table(label)}")
        if "_props" in raw.columns:
            return _parsed(raw.select("node_id", F.col("_props").alias("props")), self.model, label, props, self.bad)
        return FrameSource(self.model, {label: raw.withColumnRenamed("node_id", id_column(label))}, {}).node(label, props)

    def edge(self, child: str, link: Link) -> DataFrame:
        return _pairs(self.spark.read.parquet(f"{self.path}/{link.edge}"))

    def some_edge(self, child: str, link: Link) -> DataFrame:
        return _linked(self.spark.read.parquet(f"{self.path}/{link.edge}"))


class FrameSource:
    """Tables that are frames already.  Edges in ``unique`` have each pair once and need no distinct."""

    def __init__(self, model: GraphModel, nodes: Mapping[str, DataFrame], edges: Mapping[str, DataFrame], unique: Iterable[str] = ()) -> None:
        self.model, self.nodes, self.edges, self.unique = model, dict(nodes), dict(edges), set(unique)

    def node(self, label: str, props: Iterable[str]) -> DataFrame:
        """Properties that the frame lacks are null."""
        if label not in self.nodes:
            raise ModelError(f"no table for {label}")
        df, wanted = self.nodes[label], _wanted(self.model, label, props)
        cols = [F.col(n) if n in df.columns else F.lit(None).cast(spark_type(p)).alias(n) for n, p in wanted.items()]
        text = [c for c, (n, p) in zip(cols, wanted.items(), strict=True) if p.types[0] == "boolean" and n in df.columns]
        cols = [c.cast(SCALAR["boolean"]) if any(c is t for t in text) else c for c in cols]
        return df.select(id_column(label), *cols)

    def edge(self, child: str, link: Link) -> DataFrame:
        if link.edge not in self.edges:
            raise ModelError(f"no table for {link.edge}")
        df = self.edges[link.edge].select("child", "parent").where("child is not null and parent is not null")
        return df if link.edge in self.unique else df.distinct()


def edges_with_data(source: GraphSource) -> list[str]:
    """Link tables that hold a pair at all: one statement in a database, else one query that looks at all of them side by side, each until its first row."""
    found = {link.edge: (node.label, link) for node in source.model.nodes.values() for link in node.links}
    if isinstance(source, JdbcSource):
        return source.with_rows(sorted(found))
    out = None
    for name, (child, link) in sorted(found.items()):
        # pairs aren't compared for it, so each task ends with its first row
        some = source.some_edge(child, link) if hasattr(source, "some_edge") else source.edge(child, link).select("child", "parent")
        some = some.limit(1).select(F.lit(name).alias("name"))
        out = some if out is None else out.unionByName(some)
    return sorted(r[0] for r in out.collect()) if out is not None else []
