"""Every query with SQL gives the rows that DuckDB gives on the same tables; the others run."""

import glob
import math
import os

import duckdb
import pytest

from sagaframe.plans import catalogue

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return round(float(v), 6) if hasattr(v, "as_tuple") else v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, FOLDER)
    got = df.collect()
    if name in catalogue.ORACLE_SQL:
        want = duck.sql(catalogue.ORACLE_SQL[name])
        assert sorted(want.columns) == sorted(df.columns)
        assert rows_of(df.columns, got) == rows_of(want.columns, want.fetchall())
    else:
        assert got or name in ("story_segments", "layer_boundaries")


@pytest.mark.parametrize("name", ["graph_degree", "graph_edges", "graph_type_counts", "graphrag_relationships"])
def test_graph_of_odd_rows(spark, tmp_path, name):
    """Nulls, empty texts, and supports that differ after their first 120 characters alone."""
    con = duckdb.connect()
    odd = {
        "customer": """SELECT c_custkey, CASE WHEN c_custkey % 7 > 0 THEN c_name END AS c_name, CASE WHEN c_custkey % 11 > 0 THEN c_nationkey END AS c_nationkey, c_acctbal,
            CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN repeat('é ', 61) || k ELSE c_mktsegment || repeat('y', 130) || k END AS c_mktsegment FROM t, range(2) r(k)""",
        "orders": """SELECT o_orderkey, o_custkey, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE o_orderstatus END AS o_orderstatus, o_totalprice, o_orderdate,
            CASE WHEN o_orderkey % 13 > 0 THEN o_orderpriority END AS o_orderpriority FROM t""",
        "nation": "SELECT n_nationkey, nullif(n_name, 'NATION_3') AS n_name, n_regionkey FROM t",
        "supplier": "SELECT * FROM t",
    }
    for table, sql in odd.items():
        con.sql(f"copy (WITH t AS (SELECT * FROM '{FOLDER}/{table}.parquet') {sql}) to '{tmp_path}/{table}.parquet' (format parquet)")
        con.sql(f"create view {table} as select * from '{tmp_path}/{table}.parquet'")
    df, want = catalogue.QUERIES[name](spark, str(tmp_path)), con.sql(catalogue.ORACLE_SQL[name])
    assert rows_of(df.columns, df.collect()) == rows_of(want.columns, want.fetchall())


@pytest.mark.parametrize("name", ["graph_degree", "graph_type_counts"])
def test_graph_of_shared_ids(spark, tmp_path, name):
    """An id keeps 40 bits of its digest. Among these customers, found in 60 copies of sf0.1, two edges share theirs with another; all count."""
    con = duckdb.connect()
    few = {
        "customer": "SELECT * FROM (VALUES (412142, 'Customer#000412142', 24, 1.0, 'HOUSEHOLD'), (311965, 'Customer#000311965', 20, 2.0, 'MACHINERY'), (876213, 'Customer#000876213', 8, 3.0, 'HOUSEHOLD'), (314468, 'Customer#000314468', 19, 4.0, 'AUTOMOBILE')) c (c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment)",
        "orders": f"SELECT row_number() OVER () AS o_orderkey, c AS o_custkey, s AS o_orderstatus, 1.0 AS o_totalprice, p AS o_orderpriority FROM (VALUES (412142), (311965), (876213), (314468)) a (c), (VALUES ('O'), ('F'), ('P')) b (s), (SELECT DISTINCT o_orderpriority AS p FROM '{FOLDER}/orders.parquet')",
        "nation": f"SELECT * FROM '{FOLDER}/nation.parquet'",
        "supplier": f"SELECT * FROM '{FOLDER}/supplier.parquet'",
    }
    for table, sql in few.items():
        con.sql(f"copy ({sql}) to '{tmp_path}/{table}.parquet' (format parquet)")
        con.sql(f"create view {table} as select * from '{tmp_path}/{table}.parquet'")
    assert con.sql(f"SELECT count(*) - count(DISTINCT edge_id) FROM ({catalogue.ORACLE_SQL['graph_edges']})").fetchall() == [(2,)]
    df, want = catalogue.QUERIES[name](spark, str(tmp_path)), con.sql(catalogue.ORACLE_SQL[name])
    assert rows_of(df.columns, df.collect()) == rows_of(want.columns, want.fetchall())


def test_flagship(spark):
    assert catalogue.flagship(spark, FOLDER).count() > 0
