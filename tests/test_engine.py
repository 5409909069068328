"""Units of the engine on hand-written rows: nulls, no children, many-to-many, diamonds, empty tables."""

import http.server
import json
import re
import threading
from datetime import UTC, datetime, timedelta

import pytest
from docweave.functions import expressions as E
from docweave.functions import types as TY
from docweave.mapping import Combined, Condition, IndexJoin, MappingError, Prop, load_mappings, load_resource_paths, parse_filter, parse_mapping, parse_mappings, parse_path, resource_paths
from docweave.model import GraphModel, Link, ModelError, Node, Property
from docweave.operators.hot import collected
from docweave.operators.index_join import join_index, order
from docweave.operators.sliding import sliding_window
from docweave.plans.compiler import auth_plugin, compile_all, compile_document, trace
from docweave.cli import store_of
from docweave.sinks import IncompleteIndex, IndexStore, RestClient, SearchStore, array_config, as_json
from docweave.sources import database as DB
from docweave.sources.graph import DumpSource, FrameSource, JdbcSource, ParquetSource, edges_with_data
from docweave.sources.relgraph import RelationalSource
from docweave.streaming.gating import must_build, read_stamp, stamp, transaction_time, watch
from pyspark.sql import functions as F
from pyspark.sql import types as T


def link(name, target, backref, label="member_of", many="many_to_one"):
    return {"name": name, "target_type": target, "backref": backref, "label": label, "multiplicity": many}


SCHEMAS = {
    "program": {"category": "administrative", "properties": {"name": {"type": "string"}}},
    "project": {"category": "administrative", "properties": {"code": {"type": "string"}}, "links": [link("programs", "program", "projects")]},
    "case": {
        "category": "clinical",
        "properties": {"sex": {"enum": ["F", "M"]}, "age": {"type": ["number", "null"]}, "alive": {"type": "boolean"}, "ids": {"type": "array", "items": {"type": "integer"}}},
        "links": [{"subgroup": [link("projects", "project", "cases")]}],
    },
    "study": {"category": "clinical", "properties": {"kind": {"type": "string"}}, "links": [link("cases", "case", "studies", "of", "many_to_many")]},
    "scan": {"category": "data_file", "properties": {"size": {"type": "integer"}, "tags": {"type": "array", "items": {"type": "string"}}}, "links": [link("studies", "study", "scans", "of"), link("cases", "case", "scans", "of")]},
    "report": {"category": "data_file", "properties": {"size": {"type": ["integer", "string"]}}, "links": [link("projects", "project", "reports", "of")]},
    "stray": {"category": "data_file", "properties": {}},
    "birth": {"category": "clinical", "properties": {"year": {"type": "integer"}}, "links": [link("cases", "case", "births", "of", "one_to_one")]},
}
ROWS = {
    "program": ("name string", [("g1", "P"), ("g2", "Q")]),
    "project": ("code string", [("p1", "a-b"), ("p2", "c")]),
    "case": ("sex string, age double, alive boolean, ids array<long>", [("c1", "F", 30.0, True, [1, 2]), ("c2", "M", None, None, None), ("c3", None, 5.0, False, [2])]),
    "study": ("kind string", [("s1", "x"), ("s2", "y"), ("s3", None)]),
    "scan": ("size long, tags array<string>", [("n1", 10, ["u"]), ("n2", 20, ["u", "v"]), ("n3", None, None)]),
    "report": ("size long", [("r1", 7)]),
    "stray": (None, [("z1",)]),
    "birth": ("year long", [("b1", 1990)]),
}
EDGES = {
    "edge_projectmemberofprogram": [("p1", "g1"), ("p2", "g2")],
    "edge_casememberofproject": [("c1", "p1"), ("c1", "p1"), ("c2", "p2"), ("c3", "p1"), (None, "p1")],
    "edge_studyofcase": [("s1", "c1"), ("s1", "c2"), ("s2", "c1"), ("s3", "c1")],
    "edge_scanofstudy": [("n1", "s1"), ("n2", "s1"), ("n3", "s2")],
    "edge_scanofcase": [("n1", "c1"), ("n2", "c3")],
    "edge_reportofproject": [("r1", "p1")],
    "edge_birthofcase": [("b1", "c1")],
}


@pytest.fixture(scope="module")
def model():
    return GraphModel.from_dictionary(SCHEMAS)


@pytest.fixture(scope="module")
def source(spark, model):
    nodes = {k: spark.createDataFrame(rows, f"_{k}_id string" + (f", {cols}" if cols else "")) for k, (cols, rows) in ROWS.items()}
    edges = {k: spark.createDataFrame(rows, "child string, parent string") for k, rows in EDGES.items()}
    return FrameSource(model, nodes, edges)


def build(source, key="_case_id", plugins=(), bypass=False, root="case", **clauses):
    doc = parse_mapping({"doc_type": root, "type": "aggregator", "root": root, **clauses})
    return {r[key]: r.asDict(True) for r in compile_all(source, [doc], plugins, bypass)[root].collect()}


def test_model(model):
    assert model.resolve("case", "projects").up and not model.resolve("case", "studies").up
    assert model.resolve("case", "projects").edge == "edge_casememberofproject"
    assert [h.end for h in model.path("project", "cases.studies.scans")] == ["case", "study", "scan"]
    assert model.in_category("data_file") == ["scan", "report", "stray"]
    assert model.reaches("scan", "project") and not model.reaches("stray", "project")
    for bad in ("nothing", ""):
        with pytest.raises(ModelError):
            model.resolve("case", bad)
    with pytest.raises(ModelError):
        GraphModel.from_dictionary({"a": {"links": [link("b", "b", "as_")]}, "b": {"links": [link("a", "a", "bs")]}})
    with pytest.raises(ModelError):
        GraphModel.from_dictionary({"a": {"links": [link("b", "b", "as_")]}})


def test_property_types(spark):
    of = Property.of
    assert of({"type": ["null", "number", "string"]}).types == ("number", "string")
    assert of({"anyOf": [{"type": "null"}, {"type": "array", "items": {"type": "number"}}]}) == Property(("array",), "number")
    assert of({"enum": ["x"]}).types == ("string",)
    with pytest.raises(ModelError):
        of({"type": "null"})
    assert TY.spark_type(Property(("boolean",))) == T.StringType() and TY.spark_type(Property(("number",))) == T.DoubleType()
    assert TY.spark_type(Property(("array",))) == T.ArrayType(T.StringType())
    assert TY.index_type(Property(("string", "integer"))) == "long" and TY.index_type(Property(("integer", "number"))) == "float"
    assert TY.reduced_type("set", Property(("integer",))) == T.ArrayType(T.LongType()) and TY.reduced_type("count", Property()) == T.LongType()
    schema = T.StructType.fromDDL("_case_id string, a array<struct<b: array<int>, c: string>>, d double, e bigint")
    assert TY.array_fields(schema) == ["a", "a.b"]
    fields = TY.field_mapping(schema, "case")["mappings"]["properties"]
    assert fields["a"] == {"type": "nested", "properties": {"b": {"type": "long"}, "c": {"type": "keyword", "fields": {"analyzed": {"type": "text"}}}}}
    assert fields["d"]["type"] == "float" and fields["auth_resource_path"] == fields["node_id"] == {"type": "keyword"}


def test_grammar():
    a, b = parse_path("studies[kind, label:name].cases[]")
    assert a.link == "studies" and [(p.name, p.src) for p in a.props] == [("kind", "kind"), ("label", "name")] and b.props == ()
    for bad in ("", "a[b", "a..b", "a.", "1a"):
        with pytest.raises(MappingError):
            parse_path(bad)
    f = parse_filter({"op": "OR", "logics": [{"op": "=", "prop": "a", "value": 1}, {"op": "and", "logics": []}]})
    assert f == Combined("or", (Condition("a", "=", 1), Combined("and", ())))
    for bad in ({"type": "other"}, {"type": "aggregator", "doc_type": "x"}, {"type": "aggregator", "doc_type": "x", "root": "y", "props": [{"name": "a", "fn": "median"}]}, {"type": "aggregator", "doc_type": "x", "root": "y", "nested_props": [{"name": "n"}]}):
        with pytest.raises(MappingError):
            parse_mapping(bad)
    with pytest.raises(MappingError):
        parse_mappings({"mappings": [{"type": "collector", "doc_type": "x"}] * 2})
    doc = parse_mapping({"type": "aggregator", "doc_type": "x", "root": "y", "props": [{"name": "a"}, {"name": "a", "src": "b"}]})
    assert [p.src for p in doc.props] == ["a"]


def test_yaml(tmp_path):
    path = tmp_path / "m.yaml"
    path.write_text("mappings:\n- name: i\n  doc_type: case\n  type: aggregator\n  root: case\n  props:\n  - name: sex\n    value_mappings:\n    - F: female\n")
    assert load_mappings(str(path))[0].props[0].values == {"F": "female"}


def test_props_and_values(source):
    got = build(source, props=[{"name": "case_id", "src": "id"}, {"name": "gender", "src": "sex", "value_mappings": {"F": "female"}}, {"name": "alive"}, {"name": "unknown"}])
    assert got["c1"]["gender"] == "female" and got["c2"]["gender"] == "M" and got["c3"]["gender"] is None
    assert got["c1"]["case_id"] == "c1" and got["c1"]["alive"] == "true" and got["c2"]["alive"] is None and got["c1"]["unknown"] is None


def test_parents(source):
    got = build(source, props=[{"name": "sex"}], parent_props=[{"path": "projects[project_code:code].programs[program_name:name]"}], plugins=(auth_plugin({"c": "/other"}),))
    assert got["c1"]["project_code"] == ["a-b"] and got["c1"]["project_id"] == "P-a-b"
    assert got["c1"]["auth_resource_path"] == "/programs/P/projects/a-b" and got["c2"]["auth_resource_path"] == "/other"
    one = build(source, parent_props=[{"path": "projects[project_code:code]", "relation": "1-1"}])
    assert one["c3"]["project_code"] == "a-b" and "project_id" not in one["c3"]
    many = build(source, key="_study_id", root="study", parent_props=[{"path": "cases[sex,ids].projects[code]"}])
    assert many["s1"]["sex"] == ["F", "M"] and many["s1"]["code"] == ["a-b", "c"] and many["s1"]["ids"] == [1, 2]


def test_project_root(source):
    got = build(source, key="_project_id", root="project", aggregated_props=[{"name": "n", "path": "cases", "fn": "count"}])
    assert {k: (v["project_id"], v["n"]) for k, v in got.items()} == {"p1": ("P-a-b", 2), "p2": ("Q-c", 1)}


def test_flatten(source):
    got = build(source, flatten_props=[{"path": "births", "props": [{"name": "year"}]}, {"path": "studies", "props": [{"name": "kind"}], "sorted_by": "kind"}])
    assert got["c1"]["year"] == 1990 and got["c2"]["year"] is None
    assert got["c1"]["kind"] is None and got["c2"]["kind"] == "x" and got["c3"]["kind"] is None  # null sorts first
    got = build(source, flatten_props=[{"path": "studies", "props": [{"name": "kind"}], "sorted_by": "kind, desc"}])
    assert got["c1"]["kind"] == "y"
    got = build(source, flatten_props=[{"path": "studies.scans", "props": [{"name": "size", "fn": "max"}, {"name": "tags", "fn": "set"}]}])
    assert got["c1"]["size"] == 20 and got["c1"]["tags"] == ["u", "v"] and got["c3"]["size"] is None
    with pytest.raises(MappingError):
        build(source, flatten_props=[{"path": "studies", "props": [{"name": "kind"}]}])
    doc = parse_mapping({"doc_type": "case", "type": "aggregator", "root": "case", "flatten_props": [{"path": "studies", "props": [{"name": "kind"}]}]})
    assert compile_document(source, doc, bypass_multiplicity=True).count() == 5


def test_aggregates(source):
    agg = [("n", "studies", "count", None), ("m", "studies.scans", "count", None), ("sizes", "studies.scans", "sum", "size"), ("known", "studies.scans", "count", "size"), ("low", "studies.scans", "min", "size"), ("top", "studies.scans", "max", "size"), ("tags", "studies.scans", "set", "tags"), ("all", "studies.scans", "list", "tags"), ("kinds", "studies", "set", "kind"), ("direct", "scans", "count", None)]
    got = build(source, aggregated_props=[{"name": n, "path": p, "fn": f, **({"src": s} if s else {})} for n, p, f, s in agg])
    c1, c2, c3 = (got[k] for k in ("c1", "c2", "c3"))
    assert (c1["n"], c1["m"], c1["sizes"], c1["known"], c1["low"], c1["top"]) == (3, 3, 30, 2, 10, 20)
    assert c1["tags"] == ["u", "v"] and c1["all"] == ["u", "u", "v"] and c1["kinds"] == ["x", "y"] and c1["direct"] == 1
    assert (c2["n"], c2["m"], c2["direct"]) == (1, 2, 0)
    assert (c3["n"], c3["m"], c3["sizes"], c3["top"], c3["tags"], c3["all"], c3["direct"]) == (0, 0, None, None, [], [], 1)


def test_counting_reads_no_child_table(source):
    doc = parse_mapping({"doc_type": "case", "type": "aggregator", "root": "case", "aggregated_props": [{"name": "n", "path": "studies.scans", "fn": "count"}]})
    asked = []

    class Spy(FrameSource):
        def node(self, label, props):
            asked.append(label)
            return super().node(label, props)

    compile_document(Spy(source.model, source.nodes, source.edges), doc)
    assert asked == ["case"]


def test_nested_and_filters(source):
    nested = [{"name": "st", "path": "studies", "props": [{"name": "kind"}], "filter": {"op": "=", "prop": "kind", "value": "x"}, "nested_props": [{"path": "scans", "props": [{"name": "size"}]}]}, {"name": "group", "nested_props": [{"name": "direct", "path": "scans", "props": [{"name": "size"}]}]}, {"path": "studies.scans", "props": [{"name": "size"}]}]
    got = build(source, nested_props=nested)
    assert got["c1"]["st"] == [{"kind": "x", "scans": [{"size": 10}, {"size": 20}]}] and got["c3"]["st"] is None
    assert got["c1"]["direct"] == [{"size": 10}] and got["c1"]["studies_scans"] == [{"size": None}, {"size": 10}, {"size": 20}]
    got = build(source, nested_props=nested, filter={"op": "contains", "prop": "direct.size", "value": 20})
    assert set(got) == {"c3"}
    got = build(source, props=[{"name": "sex"}, {"name": "age"}], filter={"op": "or", "logics": [{"op": "and", "logics": [{"op": "in", "prop": "sex", "value": ["F"]}, {"op": ">", "prop": "age", "value": 1}]}, {"op": "contains", "prop": "studies__kind", "value": "x"}]})
    assert set(got) == {"c1", "c2"} and "studies__kind" not in got["c1"]
    with pytest.raises(MappingError):
        build(source, filter={"op": "=", "prop": "nothing", "value": 1})


def test_sliding(spark, source):
    rows = [("k", i, 10 * i) for i in (1, 2, 3, 5, 6, 7)] + [("one", 1, 5), ("none", None, 1)]
    df = spark.createDataFrame(rows, "k string, i int, v int")
    assert [tuple(r) for r in sliding_window(df, "k", "i", "v", 3, "sum", "max", "best").collect()] == [("k", 180)]
    got = build(source, special_props=[{"name": "w", "path": "studies.scans", "offset": "size", "src": "size", "size": 1, "fn": "sum, max"}])
    assert got["c1"]["w"] == 20 and got["c3"]["w"] is None


def test_sliding_in_blocks(spark):
    """Blocks of any size give what whole keys give, with holes, negative offsets and windows larger than a block."""
    rows = [(k, at, float((at * 7919 + k) % 101) if at % 13 else None) for k in range(3) for at in range(-60, 90) if (at + k) % 29 or k == 0]
    df = spark.createDataFrame([*rows, (5, 1, 1.0), (6, None, 2.0)], "k int, at int, v double")
    of = {k: {at: v for key, at, v in rows if key == k} for k in range(3)}
    for size in (1, 4, 28):
        for fn, over in (("sum", "max"), ("min", "sum"), ("count", "min"), ("max", "count")):
            want = {}
            ops = {"sum": lambda x: sum(x) if x else None, "min": lambda x: min(x, default=None), "max": lambda x: max(x, default=None), "count": len}
            for k in [*range(3), *([5] if size == 1 else [])]:
                have = of.get(k, {1: 1.0})
                each = [ops[fn]([have[a + i] for i in range(size) if have[a + i] is not None]) for a in have if all(a + i in have for i in range(size))]
                if each:
                    want[k] = ops[over]([x for x in each if x is not None])
            for block in (1, 10, 1 << 16):
                got = {r.k: r.x for r in sliding_window(df, "k", "at", "v", size, fn, over, "x", block).collect()}
                assert got == pytest.approx(want), (size, fn, over, block)


def test_sliding_over_a_long_key(spark):
    """A key of a million offsets is worked on by many tasks."""
    df = spark.range(1_000_000).select((F.col("id") % 1 + 1).alias("k"), F.col("id").alias("at"), (F.col("id") % 1000).alias("v"))
    out = sliding_window(df, "k", "at", "v", 5, "sum", "max", "x", block=10_000)
    assert [tuple(r) for r in out.collect()] == [(1, 995 + 996 + 997 + 998 + 999)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and re.search(r"hashpartitioning\(k#\d+L, _block", plan)
    spread = df.withColumn("_block", F.expr("at div 10000")).repartition(8, "k", "_block").select(F.spark_partition_id().alias("p")).distinct().count()
    assert spread == 8


def test_collector(source):
    doc = parse_mapping({"doc_type": "file", "type": "collector", "props": [{"name": "size"}, {"name": "tags"}, {"name": "source_node"}], "injecting_props": {"case": {"props": [{"name": "case_id", "src": "id"}, {"name": "ids"}]}, "project": {"props": [{"name": "code"}]}, "program": {"props": [{"name": "program", "src": "name"}]}}})
    rows = [r.asDict(True) for r in compile_document(source, doc).collect()]
    got = {(r["_file_id"], r["project_id"]): r for r in rows}
    assert set(got) == {("n1", "P-a-b"), ("n1", "Q-c"), ("n2", "P-a-b"), ("n2", "Q-c"), ("n3", "P-a-b"), ("r1", "P-a-b")} and len(rows) == 6
    assert got["n2", "P-a-b"]["case_id"] == ["c1", "c3"] and got["n2", "P-a-b"]["ids"] == [1, 2]
    assert got["n1", "Q-c"]["case_id"] == ["c2"] and got["n1", "Q-c"]["ids"] == [] and got["n1", "Q-c"]["program"] == ["Q"]
    assert got["r1", "P-a-b"]["source_node"] == "report" and got["r1", "P-a-b"]["case_id"] == [] and got["r1", "P-a-b"]["code"] == ["a-b"] and got["r1", "P-a-b"]["size"] == 7
    with pytest.raises(MappingError):
        compile_document(source, parse_mapping({"doc_type": "file", "type": "collector", "category": "none"}))


def test_index_joins(source):
    file = {"doc_type": "file", "name": "files", "type": "collector", "props": [{"name": "size"}], "injecting_props": {"case": {"props": [{"name": "case_id", "src": "id"}]}}}
    scan = {"doc_type": "scan", "type": "aggregator", "root": "scan", "props": [{"name": "scan_id", "src": "id"}, {"name": "size"}, {"name": "tags"}], "joining_props": [{"index": "file", "join_on": "size", "props": [{"name": "n", "src": "_file_id", "fn": "count"}, {"name": "cases", "src": "case_id", "fn": "set"}]}]}
    out = compile_all(source, parse_mappings([scan, file]))
    got = {r.scan_id: r for r in out["scan"].collect()}
    assert got["n1"].n == 2 and got["n1"].cases == ["c1", "c2"] and got["n3"].n == 0 and got["n3"].cases == []
    plain = {**scan, "joining_props": [{"index": "file", "join_on": "size", "props": [{"name": "project_id"}]}]}
    rows = compile_all(source, parse_mappings([plain, file]))["scan"].collect()
    assert sorted((r.scan_id, r.project_id or "") for r in rows) == [("n1", "P-a-b"), ("n1", "Q-c"), ("n2", "P-a-b"), ("n2", "Q-c"), ("n3", "")]
    with pytest.raises(MappingError):
        order(parse_mappings([{**scan, "joining_props": [{"index": "nowhere", "join_on": "x"}]}]))
    loop = [{"doc_type": a, "type": "collector", "joining_props": [{"index": b, "join_on": "x"}]} for a, b in (("a", "b"), ("b", "a"))]
    with pytest.raises(MappingError):
        order(parse_mappings(loop))
    bad = {**scan, "joining_props": [{"index": "file", "join_on": "nothing", "props": [{"name": "n", "fn": "count"}]}]}
    with pytest.raises(MappingError):
        compile_all(source, parse_mappings([bad, file]))


def test_empty_tables_keep_schemas(spark, source):
    none = FrameSource(source.model, {k: v.limit(0) for k, v in source.nodes.items()}, {k: v.limit(0) for k, v in source.edges.items()})
    doc = parse_mapping({"doc_type": "case", "type": "aggregator", "root": "case", "props": [{"name": "sex"}], "parent_props": [{"path": "projects[code]"}], "flatten_props": [{"path": "births", "props": [{"name": "year"}]}], "aggregated_props": [{"name": "n", "path": "studies", "fn": "count"}], "nested_props": [{"path": "studies", "props": [{"name": "kind"}]}]})
    a, b = compile_document(none, doc), compile_document(source, doc)
    assert a.count() == 0 and b.count() == 3 and a.dtypes == b.dtypes


def test_predicates(spark):
    df = spark.createDataFrame([(1, "ab", [1]), (2, None, None)], "n int, s string, a array<int>")
    run = lambda op, prop, value: [r.n for r in df.where(E.predicate(Condition(prop, op, value), F.col)).collect()]
    assert run("!=", "n", 1) == run("<>", "n", 1) == run(">", "n", 1) == [2] and run("like", "s", "a%") == run("contains", "a", 1) == run("<=", "n", 1) == run("in", "s", "ab") == [1]
    assert df.where(E.predicate(Combined("and", ()), F.col)).count() == 2 and df.where(E.predicate(Combined("or", ()), F.col)).count() == 0
    paths = spark.createDataFrame([("a-b-c",), ("x",), (None,)], "p string").select(E.resource_path(F.col("p")).alias("r")).collect()
    assert [r.r for r in paths] == ["/programs/a/projects/b-c", "", ""]
    many = spark.createDataFrame([(["a-b", "x"],)], "p array<string>").select(E.resource_paths(F.col("p"), True).alias("r")).first().r
    assert many == ["/programs/a/projects/b", ""]


def test_dump_and_parquet(spark, model, tmp_path):
    node = tmp_path / "node_case"
    node.mkdir()
    rows = [r'"2020","{}","{}","{""sex"": ""it\'s \\"x\\" ## y"", ""age"": 1.5, ""alive"": true, ""ids"": [1, 2]}","c1"'.replace(r"\'", "'").replace("\\\\", "\\").replace('\\"', '\\""'), '"2020","{}","{}","{""sex"": null}","c2"']
    (node / "part-m-00000").write_text("\n".join(rows) + "\n")
    (tmp_path / "edge_casememberofproject").mkdir()
    (tmp_path / "edge_casememberofproject" / "part-m-00000").write_text('"2020","{}","{}","{}","c1","p1"\n"2020","{}","{}","{}","c1","p1"\n')
    s = DumpSource(spark, str(tmp_path), model)
    got = {r._case_id: r for r in s.node("case", ["sex", "age", "alive", "ids"]).collect()}
    assert got["c1"].sex == "it's \"x\" ## y" and got["c1"].age == 1.5 and got["c1"].alive == "true" and got["c1"].ids == [1, 2] and got["c2"].sex is None
    hop = model.resolve("case", "projects")
    assert s.edge("case", hop.link).count() == 1
    assert s.node("study", ["kind"]).count() == 0  # no such table
    spark.createDataFrame([("c9", "F", True)], "node_id string, sex string, alive boolean").write.parquet(str(tmp_path / "p" / "node_case"))
    spark.createDataFrame([("s9", '{"kind": "k"}')], "node_id string, _props string").write.parquet(str(tmp_path / "p" / "node_study"))
    p = ParquetSource(spark, str(tmp_path / "p"), model)
    assert [tuple(r) for r in p.node("case", ["sex", "alive", "age"]).collect()] == [("c9", "F", "true", None)]
    assert [tuple(r) for r in p.node("study", ["kind"]).collect()] == [("s9", "k")]


def test_store(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "ix"))
    df = spark.createDataFrame([("c1", [1], "x")], "_case_id string, ids array<int>, s string")
    when = datetime(2024, 1, 2, 3, 4, 5, tzinfo=UTC)
    assert store.stamps(["case"]) == [None] and store.current("case") is None
    assert store.write(df, "case", "case", when) == "case_0" and store.write(df.union(df), "case", "case", when) == "case_1"
    assert store.read("case").count() == 2 and store.versions("case") == [0, 1] and store.manifest("case")["arrays"] == ["ids"]
    store.point("case", "case_0")
    assert store.read("case").count() == 1 and store.backup("case") == "0_case_0" and store.backup("case") == "1_case_0"
    assert store.write(df, "case", "case", when, partitions=2) == "case_2" and store.clean("case", keep=0) == ["case_0", "case_1"]
    assert store.versions("case") == [2] and store.stamps(["case"]) == ["20240102T030405Z"]
    with pytest.raises(FileNotFoundError):
        store.point("case", "case_9")
    with pytest.raises(FileNotFoundError):
        store.read("nothing")
    assert as_json(df, "_case_id").first() == ("c1", '{"ids":[1],"s":"x","_case_id":"c1","node_id":"c1"}')
    assert as_json(df).first() == ('{"_case_id":"c1","ids":[1],"s":"x"}',)
    assert array_config(df, "case", when).first() == ("case", ["ids"], "20240102T030405Z")
    assert trace(df, "step", None) is df and trace(df, "step", str(tmp_path)).count() == 1


def test_gating(spark, tmp_path):
    now = datetime(2024, 5, 1, 12, tzinfo=UTC)
    assert read_stamp(stamp(now)) == now
    assert must_build([None], now) and must_build([stamp(now), stamp(now - timedelta(1))], now) and must_build([stamp(now - timedelta(1))], now)
    assert not must_build([stamp(now)] * 2, now) and must_build([stamp(now)], now, force=True)
    log = spark.createDataFrame([("SUCCEEDED", "2024-05-01 10:00:00+00:00"), ("FAILED", "2024-06-01 10:00:00+00:00")], "state string, created_datetime string")
    assert transaction_time(log) == datetime(2024, 5, 1, 10, tzinfo=UTC)
    assert transaction_time(log.limit(0)).hour == 0
    log.write.parquet(str(tmp_path / "log"))
    seen = []
    stream = spark.readStream.schema(log.schema).parquet(str(tmp_path / "log"))
    watch(stream, lambda batch, n: seen.append(batch.count()), str(tmp_path / "cp")).awaitTermination(60)
    assert seen == [1]


def test_resource_paths_and_links(source, tmp_path):
    access = {"users": {"a": {"projects": [{"auth_id": "p", "resource": "/x"}, {"auth_id": "q"}]}, "b": {"projects": {"auth_id": "q", "resource": "/q"}}, "c": None}, "authz": {"user_project_to_resource": {"p": "/y"}}}
    assert resource_paths(access) == {"p": "/y", "q": "/q"} and resource_paths(None) == load_resource_paths(None) == {}
    (tmp_path / "u.yaml").write_text("rbac:\n  user_project_to_resource:\n    r: /z\n")
    assert load_resource_paths(str(tmp_path / "u.yaml")) == {"r": "/z"}
    none = FrameSource(source.model, source.nodes, source.edges | {"edge_birthofcase": source.edges["edge_birthofcase"].limit(0)})
    assert set(edges_with_data(none)) == set(EDGES) - {"edge_birthofcase"}


def test_command_line(spark, tmp_path):
    import json

    from docweave.cli import main

    (tmp_path / "d.json").write_text(json.dumps(SCHEMAS))
    (tmp_path / "m.yaml").write_text("mappings:\n- name: cases\n  doc_type: case\n  type: aggregator\n  root: case\n  props:\n  - name: sex\n")
    (tmp_path / "g" / "node_case").mkdir(parents=True)
    (tmp_path / "g" / "node_case" / "part-m-00000").write_text('"2020","{}","{}","{""sex"": ""F""}","c1"\n')
    args = ["--mapping", str(tmp_path / "m.yaml"), "--dictionary", str(tmp_path / "d.json"), "--source", f"dump:{tmp_path / 'g'}", "--out", str(tmp_path / "out")]
    assert main(args) == 0
    store = IndexStore(spark, str(tmp_path / "out"))
    assert [tuple(r) for r in store.read("cases").collect()] == [("c1", "F")]
    log = spark.createDataFrame([("SUCCEEDED", "2020-01-01 00:00:00+00:00")], "state string, created_datetime string")
    log.write.parquet(str(tmp_path / "log"))
    assert main([*args, "--transactions", str(tmp_path / "log")]) == 0 and store.versions("cases") == [0]
    assert main([*args, "--transactions", str(tmp_path / "log"), "--force"]) == 0 and store.versions("cases") == [0, 1]
    more = ["--config", "arrays", "--keep", "0", "--transactions", str(tmp_path / "log"), "--watch", str(tmp_path / "seen")]
    assert main([*args, *more]) == 0 and store.versions("cases") == [2] and store.read("arrays").first()["index"] == "cases"
    assert main([*args, *more]) == 0 and store.versions("cases") == [2]  # no new transaction


class Engine(http.server.BaseHTTPRequestHandler):
    """A search engine's indices and aliases, as far as a store needs them."""

    indices: dict = {}
    waits = 0
    logins: set = set()

    def do(self):
        type(self).logins.add(self.headers.get("Authorization"))
        path = self.path.strip("/").partition("?")[0]
        body = json.loads(self.rfile.read(int(self.headers.get("Content-Length") or 0)) or "null")
        kinds, code, out = type(self).indices, 200, {}
        name, _, rest = path.partition("/")
        if path == "_aliases":
            for (what, how), in (a.items() for a in body["actions"]):
                getattr(kinds[how["index"]]["aliases"], "add" if what == "add" else "discard")(how["alias"])
        elif path == "_reindex":
            kinds[body["dest"]["index"]] |= {"copied": body["source"]["index"], "docs": dict(kinds[body["source"]["index"]]["docs"])}
            type(self).waits, out = 2, {"task": "n:1"}
        elif name == "_tasks":
            out = {"completed": type(self).waits == 0}
            type(self).waits -= 1
        elif name == "_alias":
            out = {n: {} for n, k in kinds.items() if rest in k["aliases"]}
            code = 200 if out else 404
        elif path.endswith("*"):
            out = {n: {} for n in kinds if n.startswith(path[:-1])}
        elif self.command == "PUT" and name in kinds:
            code = 400
        elif self.command == "PUT":
            kinds[name] = {"aliases": set(), "docs": {}, **body}
        elif name not in kinds:
            code = 404
        elif self.command == "DELETE":
            del kinds[name]
        elif rest == "_count":
            out = {"count": len(kinds[name]["docs"])}
        elif rest == "_settings":
            out = {name: {"settings": {"index": {"creation_date": str(kinds[name].get("created", 0))}}}}
        elif rest == "_alias":
            out = {name: {"aliases": {a: {} for a in kinds[name]["aliases"]}}}
        else:
            out = {name: {"mappings": kinds[name]["mappings"]}}
        data = json.dumps(out).encode()
        self.send_response(code)
        self.send_header("Content-Length", str(len(data)))
        self.end_headers()
        self.wfile.write(data)

    do_GET = do_PUT = do_POST = do_DELETE = do

    def log_message(self, *_):
        pass


@pytest.fixture
def engine():
    Engine.indices, Engine.waits, Engine.logins = {}, 0, set()
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Engine)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def connector(df, resource, again=0, lost=0):
    """What a connector does: documents by their ids; a task that fails has sent its first ones already."""
    docs = Engine.indices[resource.partition("/")[0]]["docs"]
    rows = [r.asDict() for r in df.collect()]
    for r in rows[:again] + rows[: len(rows) - lost]:
        docs[r["_document_id"]] = {k: v for k, v in r.items() if k != "_document_id"}


def test_documents_are_there_once(spark, engine):
    df = spark.createDataFrame([(f"c{k}", f"p{k % 2}", k) for k in range(10)] + [("c1", "p0", 1)], "_case_id string, project_id string, n int")
    store = SearchStore(RestClient(engine), write=lambda df, resource: connector(df, resource, again=7))
    assert store.write(df, "case", "case") == "case_0" and store.current("case") == "case_0"
    assert len(Engine.indices["case_0"]["docs"]) == 11 and {"c1/p1", "c1/p0"} <= set(Engine.indices["case_0"]["docs"])
    store.save = lambda df, resource: connector(df, resource, lost=1)
    with pytest.raises(IncompleteIndex, match="10 documents of 11"):
        store.write(df, "case", "case")
    assert store.current("case") == "case_0" and store.versions("case") == [0, 1] and store.clean("case") == ["case_1"]
    several = spark.createDataFrame([("c1", 5), ("c1", 5), ("c1", 6), (None, 7)], "_case_id string, n int")
    store.save = connector
    store.commit({"many": store.stage(several, "many", "case", unique=False)})
    assert sorted(Engine.indices["many_0"]["docs"]) [-3:] == ["c1/1", "c1/2", "c1/3"] and len(Engine.indices["many_0"]["docs"]) == 4
    plain = spark.createDataFrame([("x", [1])], "index string, array array<int>")
    assert store.write(plain, "arrays", "array_config") == "arrays_0" and store.write(plain.limit(0), "arrays", "array_config") == "arrays_1"


def test_whole_builds_or_none(spark, engine, tmp_path):
    """Three indices of a run: the second one's failure leaves readers all three old ones."""
    df = spark.createDataFrame([("c1", 1)], "_case_id string, n int")
    broken = df.withColumn("n", F.raise_error("lost").cast("int"))
    for store in (IndexStore(spark, str(tmp_path / "ix")), SearchStore(RestClient(engine), write=connector)):
        names = ["a", "b", "c"]
        store.commit({n: store.stage(df, n, "case") for n in names})
        with pytest.raises(Exception, match="lost"):
            store.commit({n: store.stage(broken if n == "b" else df, n, "case") for n in names})
        assert [store.current(n) for n in names] == ["a_0", "b_0", "c_0"]
        assert store.clean("a") == [] if isinstance(store, IndexStore) else True  # begun just now
        assert store.clean("a", stale=timedelta(0)) == ["a_1"] and store.clean("b", stale=timedelta(0)) == ["b_1"] and store.clean("c") == []
        store.commit({n: store.stage(df.withColumn("n", F.lit(2)), n, "case") for n in names})
        assert len({store.current(n).partition("_")[2] for n in names}) == 1 or [store.current(n) for n in names] == ["a_1", "b_1", "c_1"]
        with pytest.raises(FileNotFoundError):
            store.commit({"a": "a_0", "b": "b_77"})
        assert store.current("a") == "a_1"
        store.point("a", "a_0")
        assert store.current("a") == "a_0" and store.clean("a", stale=timedelta(0)) == [] and 1 in store.versions("a")
    files = IndexStore(spark, str(tmp_path / "ix"))
    files.files.delete("_current.3")
    files.files.write("b_1", "old", "CURRENT.4")  # a store in which each index had its own pointer
    assert files.current("old") == "b_1" and len([n for n in files.files.names() if n.startswith("_current")]) <= 2


def test_login_and_backup_task(spark, engine):
    client = RestClient(engine, "me", "secret", every=0.01)
    store = SearchStore(client, write=connector)
    store.write(spark.createDataFrame([("c1", 1), ("c2", 2)], "_case_id string, n int"), "case", "case")
    assert store.backup("case") == "backup_0_case_0" and Engine.waits == -1 and len(Engine.indices["backup_0_case_0"]["docs"]) == 2
    assert Engine.logins == {"Basic bWU6c2VjcmV0"}
    found = store_of(spark, "https://search:9243", "parquet", {"user": "me", "password": "secret", "es.batch.size.bytes": "4mb"})
    assert found.options == {
        "es.nodes": "search", "es.port": "9243", "es.nodes.wan.only": "true", "es.net.ssl": "true",
        "es.net.http.auth.user": "me", "es.net.http.auth.pass": "secret", "es.batch.size.bytes": "4mb",
    }
    assert found.client.tls is not None and found.client.headers["Authorization"].startswith("Basic ")


def test_search_store(spark, engine, tmp_path):
    def save(df, resource):
        df.write.parquet(f"{tmp_path}/{resource}")
        connector(spark.read.parquet(f"{tmp_path}/{resource}"), resource)

    store = SearchStore(RestClient(engine, every=0.01), write=save)
    df = spark.createDataFrame([("c1", [1], "x")], "_case_id string, ids array<int>, s string")
    when = datetime(2024, 1, 2, 3, 4, 5, tzinfo=UTC)
    assert store.stamps(["case"]) == [None] and store.current("case") is None and store.versions("case") == []
    assert store.write(df, "case", "case", when) == "case_0" and store.write(df, "case", "case", when) == "case_1"
    assert store.current("case") == "case_1" and store.versions("case") == [0, 1] and store.stamps(["case", "none"]) == ["20240102T030405Z", None]
    assert Engine.indices["case_1"]["mappings"]["properties"]["ids"] == {"type": "long"} and Engine.indices["case_0"]["aliases"] == {"time_20240102T030405Z"}
    assert spark.read.parquet(f"{tmp_path}/case_1/case").count() == 1
    assert store.backup("case") == "backup_0_case_1" and store.backup("case") == "backup_1_case_1" and store.backup("none") is None
    assert Engine.indices["backup_0_case_1"]["copied"] == "case_1"
    store.point("case", "case_0")
    assert store.current("case") == "case_0" and store.clean("case", keep=0) == []
    store.point("case", "case_1")
    assert store.clean("case", keep=0) == ["case_0"] and store.versions("case") == [1]
    with pytest.raises(FileNotFoundError):
        store.point("case", "case_9")


def test_database(spark, tmp_path):
    url = "jdbc:derby:memory:graph;create=true"
    connection = spark._jvm.java.sql.DriverManager.getConnection(url)
    run = connection.createStatement().execute
    run('create table node_case ("node_id" varchar(20), "_props" varchar(200))')
    run('create table edge_caseproject ("src_id" varchar(20), "dst_id" varchar(20))')
    run('create table edge_none ("src_id" varchar(20), "dst_id" varchar(20))')
    run("create table transaction_logs (x int)")
    for k in ("c", "ca", "cas"):
        run(f"""insert into node_case values ('{k}', '{{"sex": "F"}}')""")
    run("insert into edge_caseproject values ('c', 'p'), ('c', 'p'), (null, 'p')")
    link_to = lambda edge: Link("projects", "project", "cases", edge, "many_to_one")
    nodes = [Node("case", "clinical", {"sex": Property(("string",))}, (link_to("edge_caseproject"),)), Node("project", "administrative", {}, ()), Node("x", "clinical", {}, (link_to("edge_none"),))]
    for partitions in (1, 3):
        source = JdbcSource(spark, url, GraphModel(nodes), partitions=partitions)
        assert source.tables() == ["edge_caseproject", "edge_none", "node_case"]
        assert edges_with_data(source) == ["edge_caseproject"]
        assert sorted(tuple(r) for r in source.node("case", ["sex"]).collect()) == [("c", "F"), ("ca", "F"), ("cas", "F")]
        assert [tuple(r) for r in source.edge("case", nodes[0].links[0]).collect()] == [("c", "p")]
        source.export(str(tmp_path / f"copy{partitions}"))
        copy = ParquetSource(spark, str(tmp_path / f"copy{partitions}"), source.model)
        assert copy.node("case", ["sex"]).count() == 3 and copy.edge("case", nodes[0].links[0]).count() == 1
    connection.close()


def test_parts_at_one_moment(spark, tmp_path, monkeypatch):
    """Parts of a table are even, also of ids of one length and of an id with many pairs; what is added meanwhile isn't seen."""
    url = "jdbc:derby:memory:moment;create=true"
    connection = spark._jvm.java.sql.DriverManager.getConnection(url)
    run = connection.createStatement().execute
    run("call syscs_util.syscs_set_database_property('derby.locks.waitTimeout', '1')")
    run('create table node_case ("node_id" varchar(20), "_props" varchar(200))')
    run('create table edge_caseproject ("src_id" varchar(20), "dst_id" varchar(20))')
    rows = ", ".join(f"""('c{k:03d}', '{{"sex": "F"}}')""" for k in range(200))
    run(f"insert into node_case values {rows}, (null, '{{}}')")
    run("insert into edge_caseproject values " + ", ".join(f"('c000', 'p''{k:03d}')" for k in range(150)) + ", ('c001', 'p'), ('c001', null)")
    model = GraphModel([Node("case", "clinical", {"sex": Property(("string",))}, (Link("projects", "project", "cases", "edge_caseproject", "many_to_one"),)), Node("project", "administrative", {}, ())])
    source = JdbcSource(spark, url, model, partitions=4, rows_per_part=40)
    for table in ("node_case", "edge_caseproject"):
        sizes = source._read(table).groupBy(F.spark_partition_id()).count().collect()
        sizes = [r["count"] for r in sizes]
        assert len(sizes) == 4 and max(sizes) <= 2 * min(sizes) and sum(sizes) == {"node_case": 201, "edge_caseproject": 152}[table]
    blocked = []
    copy = JdbcSource._copy

    def copy_and_add(self, table, path, seen):
        n = copy(self, table, path, seen)
        for t in ("node_case", "edge_caseproject"):
            try:
                run(f"insert into {t} values ('new', 'new')")
            except Exception as e:  # noqa: BLE001  writers wait, here for a second
                blocked.append(str(e))
        return n

    monkeypatch.setattr(JdbcSource, "_copy", copy_and_add)
    assert source.export(str(tmp_path / "copy"), at_once=1) == {"edge_caseproject": 152, "node_case": 201}
    assert len(blocked) == 4 and all("lock" in b for b in blocked)
    assert spark.read.parquet(str(tmp_path / "copy" / "node_case")).where("node_id = 'new'").count() == 0
    run("insert into node_case values ('new', 'new')")  # and after it all goes on
    connection.close()


def test_statements_of_databases():
    """Statements for databases that aren't here."""
    pg = DB.DIALECTS["postgresql"]
    asked = []
    read = lambda s: asked.append(s) or [(10_000_000, 900)]
    found = DB.plan(read, pg, "node_case", '"node_id"', 4, 1_000_000, still=True)
    assert found[0] == "ctid >= '(0,0)'::tid and ctid < '(225,0)'::tid" and found[-1].endswith("ctid < '(4294967295,0)'::tid") and len(found) == 4 and len(asked) == 1
    assert DB.plan(read, pg, "node_case", '"node_id"', 1, 1) == ["1 = 1"] and DB.plan(lambda s: [(5, 1)], pg, "t", "k", 8, 10) == ["1 = 1"]
    my = DB.DIALECTS["mysql"]
    found = DB.plan(lambda s: [(100, 0)] if "table_rows" in s else [(50, "b'c"), (25, "a"), (75, "b'c")], my, "t", "`k`", 4, 10)
    assert found == ["`k` <= 'a' or `k` is null", "`k` > 'a' and `k` <= 'b''c'", "`k` > 'b''c'"]
    asked.clear()
    assert DB.plan(lambda s: [(10_000_000, 900)] if "pg_class" in s else [(1, "a")], pg, "t", "k", 4, 1_000_000) == ["k <= 'a' or k is null", "k > 'a'"]  # rows may move
    DB.plan(lambda s: asked.append(s) or [(100, 0)], my, "t", "`k`", 4, 10)
    assert asked[1] == "select n, k from (select row_number() over (order by `k`) as n, `k` as k from t where `k` is not null) as b where mod(n, 25) = 0"
    assert "snapshot '{name}'" in pg.take and my.lock.format(tables=" read, ".join(["a", "b"])) == "lock tables a read, b read"


def test_bad_records(spark, model, tmp_path):
    good = '"2020","{}","{}","{""sex"": ""F"", ""age"": 3}","c1"\n'
    bad = ['"2020","{}","{}","{""sex"": BROKEN","c2"\n', '"2020","{}","{}","{""sex"": ""M"", ""age"": ""x""}","c3"\n', '"2020","{}","{}"\n', '"2020","{}","{}","{}",\n']
    for table, lines in (("node_case", [good, *bad]), ("edge_studyofcase", ['"2020","{}","{}","{}","s1","c1"\n', '"2020","{}","{}","{}","s1"\n'])):
        (tmp_path / "g" / table).mkdir(parents=True)
        (tmp_path / "g" / table / "part-m-00000").write_text("".join(lines))
    source = DumpSource(spark, str(tmp_path / "g"), model)
    with pytest.raises(Exception, match="bad record in node_case"):
        source.node("case", ["sex", "age"]).collect()
    with pytest.raises(Exception, match="bad record in edge_studyofcase"):
        source.edge("study", model.resolve("study", "cases").link).collect()
    source = DumpSource(spark, str(tmp_path / "g"), model, bad="split")
    assert [tuple(r) for r in source.node("case", ["sex", "age"]).where("_case_id is not null").collect()] == [("c1", "F", 3.0)]
    assert [tuple(r) for r in source.node("case", ["sex"]).where("_case_id = 'c3'").collect()] == [("c3", "M")]  # the number isn't asked for
    assert source.edge("study", model.resolve("study", "cases").link).count() == 1
    assert source.quarantine(str(tmp_path / "q")) == {"node_case": 4, "edge_studyofcase": 1}
    told = spark.read.parquet(str(tmp_path / "q"))
    assert sorted((r.table_name, r.id or "", r.reason) for r in told.collect()) == [
        ("edge_studyofcase", "s1", "columns"), ("node_case", "", "columns"), ("node_case", "", "id"), ("node_case", "c2", "properties"), ("node_case", "c3", "properties"),
    ]
    assert "BROKEN" in told.where("id = 'c2'").first()["record"]
    with pytest.raises(ValueError, match="fail or split"):
        DumpSource(spark, str(tmp_path / "g"), model, bad="no").node("case", ["sex"])


def test_links_with_data_in_one_query(spark, model, tmp_path):
    for table in ("edge_studyofcase", "edge_scanofcase"):
        (tmp_path / table).mkdir()
        (tmp_path / table / "part-m-00000").write_text('"2020","{}","{}","{}","s1","c1"\n' * (table == "edge_studyofcase") + '"2020","{}","{}","{}",,"c1"\n' * 3)
    source = DumpSource(spark, str(tmp_path), model)
    spark.sparkContext.setJobGroup("links", "")
    assert edges_with_data(source) == ["edge_studyofcase"]
    spark.sparkContext.setJobGroup("", "")
    edges = sum(len(n.links) for n in model.nodes.values())
    # one query, whose stages run side by side: a job for each and one for the result
    assert edges > 4 and len(spark.sparkContext.statusTracker().getJobIdsForGroup("links")) <= edges + 1


def test_clashes_are_told(spark):
    left, right = spark.createDataFrame([("a", 1)], "k string, v int"), spark.createDataFrame([("a", 2)], "k string, v int")
    spec = IndexJoin("other", ("k",), (Prop("v", "v"),))
    with pytest.warns(UserWarning, match="v is there already"):
        assert [tuple(r) for r in join_index(left, right, spec).collect()] == [("a", 1)]


def test_entry_points():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert "subject_document" in e.queries()


def test_children_of_large_parents_are_collected_in_parts(spark):
    source = RelationalSource(spark, "/root/testdata/sf0.001")
    block = {"name": "lines", "path": "subjects.samples", "props": [{"name": "o_orderkey"}, {"name": "o_orderstatus"}], "nested_props": [{"name": "of", "path": "aliquots", "props": [{"name": "l_linenumber"}]}]}

    def rows(**more):
        doc = parse_mapping({"doc_type": "project", "type": "aggregator", "root": "project", "props": [{"name": "n_nationkey"}], "nested_props": [block | more]})
        return compile_document(source, doc).orderBy("n_nationkey")

    spread, whole = rows(), rows(spread=False)  # a project's children are spread unless the block says otherwise
    assert spread.collect() == whole.collect() and spread.schema == whole.schema
    assert "pmod(xxhash64" in spread._jdf.queryExecution().executedPlan().toString() and "pmod(xxhash64" not in whole._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(MappingError, match="spread"):
        rows(spread="often")


def test_collecting_in_parts(spark):
    # one parent has two thirds of all rows; equal rows, a null member, a null value and a parent of one
    df = spark.range(3000).selectExpr("if(id % 3 < 2, 'hot', concat('k', id % 7)) as key", "nullif(id, 5) as member", "nullif(id % 11, 3) as a", "array(id % 2) as b")
    df = df.unionByName(df.where("member < 40")).unionByName(spark.sql("select 'one' as key, 1L as member, 2L as a, array(3L) as b"))
    row = F.struct("a", "b")
    want = {r.key: r.rows for r in df.groupBy("key").agg(F.sort_array(F.collect_list(row)).alias("rows")).collect()}
    for parts in (1, 7, 64):
        assert {r.key: r.rows for r in collected(df, "key", "member", row, "rows", parts).collect()} == want
    assert collected(df.limit(0), "key", "member", row, "rows").collect() == []
    largest = {r.key: r.n for r in df.groupBy("key").agg(F.sum(F.octet_length(F.to_json(row))).alias("n")).collect()}
    assert {r.key: r.rows for r in collected(df, "key", "member", row, "rows", budget=largest["hot"]).collect()} == want
    for parts in (1, 64):  # told of in the first step where one part is too large, and in the second otherwise
        with pytest.raises(Exception, match="rows: the children of hot take more than"):
            collected(df, "key", "member", row, "rows", parts, largest["hot"] - 1).collect()
    binary = df.withColumn("key", F.encode("key", "utf-8"))
    with pytest.raises(Exception, match="the children of 686F74 take"):
        collected(binary, "key", "member", row, "rows", budget=largest["hot"] - 1).collect()
    # rows are exchanged once by key and part, and sorted parts once by key
    kept = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = collected(df, "key", "member", row, "rows")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", kept)
    asked = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert len(asked) == 2 and sorted("_part#" in x for x in asked) == [False, True]
