"""Every registered query of the engine against its SQL, as multisets of rows."""

import os

import duckdb
import pytest
from docweave.plans import queries as plans

TABLES = "region nation customer supplier part orders lineitem events documents labels".split()


def plain(v):
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    if isinstance(v, float):
        return round(v, 6)
    return str(v) if hasattr(v, "isoformat") else v


@pytest.fixture(scope="module")
def duck():
    d = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    return d, con


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query(spark, duck, name):
    d, con = duck
    df = plans.queries()[name](spark, d)
    sql = plans.oracle_sql().get(name)
    rows = df.collect()
    if sql is None:
        assert rows
        return
    cur = con.execute(sql)
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    order = sorted(cols)
    want = sorted(repr([plain(r[cols.index(c)]) for c in order]) for r in cur.fetchall())
    got = sorted(repr([plain(r[c]) for c in order]) for r in rows)
    assert got == want


def odd_tables(path, **changed):
    """The smallest tables with some of them replaced by a SELECT, and a connection that has them as views."""
    d, source, con, given = str(path), "/root/testdata/sf0.001", duckdb.connect(), duckdb.connect()
    for t in TABLES:
        given.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{source}/{t}.parquet')")
    for t in TABLES:
        given.sql(f"COPY ({changed.get(t, f'SELECT * FROM {t}')}) TO '{d}/{t}.parquet' (FORMAT parquet)")
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    return d, con


def test_customers_without_orders_and_broken_quantities(spark, tmp_path):
    d, con = odd_tables(
        tmp_path,
        orders="SELECT * FROM orders WHERE o_custkey % 10 <> 3",
        lineitem="SELECT * REPLACE (l_quantity + (l_linenumber % 4) / 4 AS l_quantity) FROM lineitem WHERE l_orderkey % 5 <> 0",
    )
    assert con.sql("SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)").fetchall()[0][0] > 0
    test_query(spark, (d, con), "nested_two_level")


@pytest.mark.parametrize("name", ["collector_diamond", "collector_lineage", "collector_single_parent"])  # the SQL of collector_union has lines with both parents only
def test_lines_without_parents_twice_or_under_one_project(spark, tmp_path, name):
    d, con = odd_tables(
        tmp_path,
        supplier="SELECT * REPLACE (CASE WHEN s_suppkey % 2 = 0 THEN 3 ELSE s_nationkey END AS s_nationkey) FROM supplier WHERE s_suppkey % 5 <> 1",
        customer="SELECT * REPLACE (CASE WHEN c_custkey % 2 = 0 THEN 3 ELSE c_nationkey END AS c_nationkey) FROM customer WHERE c_custkey % 7 <> 0",
        orders="SELECT * FROM orders WHERE o_orderkey % 11 <> 0",
        lineitem="WITH l AS (SELECT * REPLACE (CASE WHEN l_linenumber <> 2 THEN l_orderkey END AS l_orderkey, CASE WHEN l_linenumber % 3 > 0 THEN l_suppkey END AS l_suppkey) FROM lineitem) "
        "SELECT * FROM l UNION ALL SELECT * FROM l WHERE l_orderkey IS NULL OR l_orderkey % 3 = 0",
    )
    test_query(spark, (d, con), name)
