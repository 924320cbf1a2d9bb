"""Every registered query: no cross join in its plan, and its DuckDB twin agrees."""
import contextlib
import io as _io
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, norm  # noqa: E402

SF = "/root/testdata/sf0.001"
SLOW = {"gbt_forecast", "tree_holdout", "model_error", "min_cost_plan", "min_cost_gap", "min_cost_rule"}
# the text queries have plans and tests of their own in tests/llm
OWN = sorted(set(E.catalog.QUERIES) - SLOW)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", OWN)
def test_no_cross_join(spark, name, monkeypatch):
    """The whole plan, with nothing written in between."""
    monkeypatch.setattr(E.catalog, "KEEP", False)
    buf = _io.StringIO()
    with contextlib.redirect_stdout(buf):
        E.queries()[name](spark, SF).explain()
    plan = buf.getvalue()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF).toPandas()
    exp = duck.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert norm(got) == norm(exp)


@pytest.mark.parametrize("name", ["greedy_plan", "rolling_features", "plan_explained",
                                  "trend_weekly_forecast", "execution_summary"])
def test_partition_independent(spark, name):
    results = []
    for n in (2, 7):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        results.append(norm(E.queries()[name](spark, SF).toPandas()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]
