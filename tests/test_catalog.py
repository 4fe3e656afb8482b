"""Every catalogue query against its DuckDB oracle, plus entry() and plan shape."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from blockwise.plans import catalog, oracle
from blockwise.sources.tables import TABLES
from conftest import SF_SMALL

QUERIES = catalog.queries()
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(rows, cols):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    def v(x):
        return round(x, 9) if isinstance(x, float) and not math.isnan(x) else x
    return sorted((tuple(v(r[i]) for i in idx) for r in rows), key=lambda t: [(x is None, str(x)) for x in t])


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(res.fetchall(), ocols)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns[0] == "physical_id" and df.count() > 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_or_cartesian(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, (name, bad)


@pytest.mark.parametrize("name", ["segment_trend", "pip_zone_count", "fmt_topk_line", "zone_rate"])
def test_headline_joins_are_broadcast(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_scan_is_pruned(spark):
    df = QUERIES["segment_trend"](spark, SF_SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    # orders: only key, customer and date are read
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in text
