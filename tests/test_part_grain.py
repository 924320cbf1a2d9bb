"""Plans by part: what a task holds does not grow with the line items (F1, F2 of round 3)."""
import datetime as dt
import random
import re

import pytest

from restock.plans import catalog
from restock.sources import tpch


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd, root = random.Random(5), str(tmp_path_factory.mktemp("parts"))
    day = dt.datetime(1998, 1, 1)
    lines = [(i, rnd.choice([None, *range(60)]) if i % 50 == 0 else rnd.randrange(60), rnd.randrange(12), float(rnd.randint(1, 50)),
              100.0, 0.1, None if i % 97 == 0 else day + dt.timedelta(rnd.randrange(90))) for i in range(2000)]
    tables = {"lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
                                  "l_discount double, l_shipdate timestamp"),
              "supplier": ([(s, s % 5) for s in range(12)], "s_suppkey long, s_nationkey long"),
              "nation": ([(n, f"N{n}") for n in range(5)], "n_nationkey long, n_name string"),
              "part": ([(p, f"Brand#{p % 25 + 1}", "T", 9.0) for p in range(60)], "p_partkey long, p_brand string, p_type string, p_retailprice double")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.mark.parametrize("query", ["greedy_plan_by_part", "feasible_sources_by_part"])
def test_tasks_follow_the_line_items(spark, folder, monkeypatch, capsys, query):
    session = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = {}
    for most in (2000, 100):                # 20 tasks of 100 lines; the session has 4
        monkeypatch.setattr(tpch, "TASK_ROWS", most, raising=False)
        found[most] = sorted(map(str, getattr(catalog, query)(spark, folder).collect()))
    assert found[100] and found[100] == found[2000]
    monkeypatch.setattr(catalog, "KEEP", False)
    getattr(catalog, query)(spark, folder).explain()
    dealt = [int(n) for n in re.findall(r"hashpartitioning\([^)]*, (\d+)\)", capsys.readouterr().out)]
    assert session < 20 and dealt and min(dealt) >= 20
