"""Plans: what is read, how often rows are exchanged, and that no Python runs in them."""

import re

import pytest
from docweave.mapping import parse_mapping
from docweave.operators.aggregator import compile_aggregator, nested_branch
from docweave.plans import queries as plans
from docweave.sources.relgraph import RelationalSource
from pyspark.sql import functions as F

D = "/root/testdata/sf0.001"


def plan(spark, name):
    return plans.queries()[name](spark, D)._jdf.queryExecution().executedPlan().toString()


def reads(text, column):
    return [m for m in re.findall(r"ReadSchema: struct<([^>]*)>", text) if column in m]


@pytest.mark.parametrize("name", sorted(plans.MAPPED))
def test_no_python(spark, name):
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoopJoin", plan(spark, name))


def test_counts_read_keys_only(spark):
    text = plan(spark, "agg_count_two_hop")
    assert reads(text, "l_orderkey") == ["l_orderkey:bigint"]
    assert all("o_totalprice" not in m for m in reads(text, "o_orderkey"))


def test_filters_reach_the_scan(spark):
    text = plan(spark, "filter_and_or")
    assert "c_acctbal" in re.search(r"PushedFilters: \[([^\]]*)", text)[1]
    text = plan(spark, "filter_in")
    assert "In(o_orderpriority" in text


def test_partial_aggregation_before_the_exchange(spark):
    text = plan(spark, "agg_count_two_hop")
    assert text.count("partial_count") >= 1
    assert "partial_max" in plan(spark, "flatten_sorted_desc") and "Window" not in plan(spark, "flatten_sorted_desc")


def scans(text):
    """How often each table is read, and exchanges that aren't another one used again."""
    text = text.partition("== Initial Plan ==")[0]
    tables = re.findall(r"Scan parquet.*?/(\w+)\.parquet", text)
    return {t: tables.count(t) for t in tables}, len(re.findall(r"^\W*Exchange", text, re.M))


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def ran(spark, name):
    df = plans.queries()[name](spark, D)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["collector_union", "collector_lineage", "collector_diamond"])
def test_lineage_is_read_once(spark, no_broadcast, name):
    tables, exchanges = scans(ran(spark, name))
    assert tables.pop("lineitem") <= 2  # once for its links and once for its properties
    assert set(tables.values()) == {1} and exchanges <= 13


@pytest.mark.parametrize("name", ["collector_union", "collector_lineage", "collector_diamond", "collector_single_parent"])
def test_lines_are_read_once_and_merged_in_their_rows(spark, no_broadcast, name):
    tables, _ = scans(text := ran(spark, name))
    assert tables["lineitem"] == 1
    lines = len(spark.read.parquet(f"{D}/lineitem.parquet").collect())
    df = plans.queries()[name](spark, D)
    df.collect()
    dealt = [int(n) for n in rows_dealt(df._jdf.queryExecution().executedPlan())]
    assert max(dealt) <= lines and "collect_set" not in text  # no row for each of a line's parents is dealt out


def rows_dealt(plan):
    """Rows that each exchange of an executed plan wrote."""
    out, todo = [], [plan.executedPlan()]
    while todo:
        at = todo.pop()
        metric = at.metrics().get("shuffleRecordsWritten")
        if metric.isDefined():
            out.append(metric.get().value())
        todo += [at.plan()] if "QueryStage" in at.getClass().getSimpleName() else [at.children().apply(i) for i in range(at.children().size())]
    return out


def test_documents_read_each_table_once(spark, no_broadcast):
    tables, exchanges = scans(ran(spark, "subject_document"))
    assert set(tables) >= {"customer", "orders", "lineitem", "events", "nation", "region"} and set(tables.values()) == {1} and exchanges <= 9


def test_selective_filters_leave_few_rows_for_other_branches(spark):
    source, doc = RelationalSource(spark, D), parse_mapping(plans._RARE)
    few = compile_aggregator(source, doc, selective=True).select(F.col("_subject_id").alias("near"))
    n, block = few.count(), doc.nested[0]
    every, some = (nested_branch(source, "subject", block, k).select(F.size("samples").alias("n")).agg(F.count("n"), F.sum("n")).first() for k in (None, few))
    assert 0 < n < 20 and some[0] == n and every[0] > 4 * some[0] and every[1] > 4 * some[1]
    kept = []
    compile_aggregator(source, doc, selective=True, kept=kept).collect()
    assert len(kept) == 1 and kept[0].count() == n
    kept[0].unpersist()
