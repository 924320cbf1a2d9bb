"""Readers / writers (A1-A14) and the driver contract."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from restock import schemas
from restock.sources import io


def test_csv_roundtrip_and_counts(spark):
    d = tempfile.mkdtemp(prefix="restock-io-")
    df = spark.createDataFrame([("W1", "n", None, 1.0, 2.0, 3.0, None, 1, None, 0.1, 2.0, None,
                                 None, None, 0)], schemas.WAREHOUSES)
    assert io.write_table(df, f"{d}/warehouses.csv", fmt="csv") == 1
    back = io.read_table(spark, f"{d}/warehouses.csv", schemas.WAREHOUSES)
    # file sources read every column as nullable; names and types are kept
    assert [(f.name, f.dataType) for f in back.schema] == \
        [(f.name, f.dataType) for f in schemas.WAREHOUSES]
    assert back.count() == 1
    tables = io.load_raw_tables(spark, d)
    assert set(tables) == {"warehouses"}
    with pytest.raises(ValueError):
        io.require_tables(tables)


def test_optional_source_keeps_schema(spark):
    df = io.read_optional(spark, "/nonexistent/fleet.csv", schemas.FLEET)
    assert df.count() == 0 and df.schema == schemas.FLEET


def test_earlier_plans_stay_and_ties_are_settled(spark):
    d = tempfile.mkdtemp(prefix="restock-io-")
    plan = E.entry(spark).persist()
    n = plan.count()
    for name in ("PLAN-1", "PLAN-2", "PLAN-1"):
        assert io.write_table(plan.withColumn("plan_id", F.lit(name)), f"{d}/plans", partition_by=["plan_id"]) == n
    back = io.read_table(spark, f"{d}/plans", schemas.PLAN)
    assert {r.plan_id: r["count"] for r in back.groupBy("plan_id").count().collect()} == {"PLAN-1": n, "PLAN-2": n}
    for order in (F.col("plan_id"), F.col("plan_id").desc()):    # both ran on one day
        newest = io.newest_plan(back.orderBy(order)).select("plan_id").distinct().collect()
        assert [r[0] for r in newest] == ["PLAN-2"]


def test_warehouse_order_follows_files_whatever_their_size(spark):
    d = tempfile.mkdtemp(prefix="restock-io-")
    os.makedirs(f"{d}/warehouses.csv")
    for i, names in enumerate((["W9"], [f"W{k}" for k in range(8)])):
        with open(f"{d}/warehouses.csv/part-{i}.csv", "w") as f:
            f.write("warehouse_id,name\n" + "".join(f"{n},{'x' * 50}\n" for n in names))
    got = io.read_table(spark, f"{d}/warehouses.csv", schemas.WAREHOUSES).orderBy("source_ord")
    assert [r.warehouse_id for r in got.collect()] == ["W9", *[f"W{k}" for k in range(8)]]


def test_entry_and_contract(spark):
    assert E.entry(spark).count() > 0
    q, o = set(E.queries()), set(E.oracle_sql())
    assert o <= q
    assert set(E.catalog.QUERIES) - o == {"capacity_days", "gbt_forecast", "tree_holdout", "model_error", "min_cost_plan", "min_cost_gap"}


def test_entry_schema_is_the_plan_table(spark):
    df = E.entry(spark)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schemas.PLAN]
