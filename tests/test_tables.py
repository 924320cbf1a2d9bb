"""Malformed rows, versions of tables, the plan manifest and declared rules."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from restock import schemas
from restock.operators import quality
from restock.plans import stages
from restock.sources import io

SF = "/root/testdata/sf0.001"


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_malformed_rows_go_to_the_quarantine(spark, tmp_path):
    write(tmp_path / "sales_history.csv",
          "date,warehouse_id,sku_id,quantity_sold,revenue\n"
          "2024-01-01,W1,A,3.0,1.5\n"
          "2024-13-01,W1,A,4,1.5\n"            # no such month
          "2024-01-02,W1,A,many,x\n"           # two bad cells
          "2024-01-03,W1,A,5\n"                # a field short
          "2024-01-03,W1,A,5,1,extra\n"
          "2024-01-04,,A,,\n"                  # blanks are nulls
          "2024-01-05,W1,\"A, B\",nan,2\n"
          "2024-01-06,W1,A,1e30,2\n")
    clean, bad = io.read_checked(spark, f"{tmp_path}/sales_history.csv", schemas.SALES_HISTORY)
    assert [(f.name, f.dataType) for f in clean.schema] == [(f.name, f.dataType) for f in schemas.SALES_HISTORY]
    assert {tuple(r) for r in clean.collect()} == {(dt.date(2024, 1, 1), "W1", "A", 3, 1.5), (dt.date(2024, 1, 4), None, "A", None, None)}
    got = sorted((r.column_name or "", r.raw_value) for r in bad.collect())
    assert [g for g in got if g[0]] == [("date", "2024-13-01"), ("quantity_sold", "1e30"), ("quantity_sold", "many"),
                                        ("quantity_sold", "nan"), ("revenue", "x")]
    assert [g[1] for g in got if not g[0]] == ["2024-01-03,W1,A,5", "2024-01-03,W1,A,5,1,extra"]
    one = bad.where("raw_value = 'many'").first()
    assert one.table_name == "sales_history" and one.file.endswith("sales_history.csv") and '"date":"2024-01-02"' in one.record


def test_keys_must_be_there(spark, tmp_path):
    write(tmp_path / "warehouses.csv", "warehouse_id,name,lead_time_days\nW1,a,1\n,b,2\nW3,c,x\nW4,d,\n")
    clean, bad = io.read_checked(spark, f"{tmp_path}/warehouses.csv", schemas.WAREHOUSES)
    assert [(r.warehouse_id, r.lead_time_days, r.source_ord) for r in clean.orderBy("source_ord").collect()] == [("W1", 1, 0), ("W4", None, 3)]
    assert sorted((r.column_name, r.raw_value) for r in bad.collect()) == [("lead_time_days", "x"), ("warehouse_id", None)]


def test_parquet_cells_are_checked_too(spark, tmp_path):
    spark.createDataFrame([("a", "1"), ("b", "one")], "po_id string, quantity_ordered string").write.parquet(f"{tmp_path}/p")
    clean, bad = io.read_checked(spark, f"{tmp_path}/p", schemas.INBOUND_POS)
    assert [(r.po_id, r.quantity_ordered) for r in clean.collect()] == [("a", 1)]
    assert [(r.column_name, r.raw_value) for r in bad.collect()] == [("quantity_ordered", "one")]


def raw_tables(tmp_path):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(30)]
    write(tmp_path / "raw/warehouses.csv", "warehouse_id,name,latitude,longitude,capacity_volume_m3,lead_time_days,stockout_cost_per_unit\n"
          "W1,a,40,-100,500,1,9\nW2,b,41,-100,500,2,9\nW2,again,41,-100,500,2,-9\n")
    write(tmp_path / "raw/skus.csv", "sku_id,name,volume_m3_per_unit,safety_stock_days\nA,x,0.1,5\nB,,0.1,5\n")
    write(tmp_path / "raw/sales_history.csv", "date,warehouse_id,sku_id,quantity_sold,revenue\n"
          + "".join(f"{d},W1,A,{5 + d.weekday()},1\n{d},W2,A,7,1\n" for d in days) + "soon,W1,A,1,1\n")
    write(tmp_path / "raw/inventory_snapshot.csv", "snapshot_date,warehouse_id,sku_id,quantity_on_hand,quantity_reserved,quantity_available\n"
          "2024-01-30,W1,A,4,0,4\n2024-01-30,W2,A,400,0,400\n")
    return f"{tmp_path}/raw", f"{tmp_path}/proc"


def test_a_bad_row_does_not_stop_the_stage(spark, tmp_path):
    raw, proc = raw_tables(tmp_path)
    out = stages.etl(spark, raw, proc)
    assert out["quarantine"] == 1 and out["daily_sales_aggregated"] == 60
    assert io.read_table(spark, f"{proc}/quarantine").first().raw_value == "soon"
    broken = {(r.table_name, r.rule, r.column_name): r.violations for r in io.read_table(spark, f"{proc}/rule_report").where("violations > 0").collect()}
    assert broken == {("warehouses", "unique", "warehouse_id"): 1, ("warehouses", "not_negative", "stockout_cost_per_unit"): 1,
                      ("skus", "required", "name"): 1}


def test_new_days_are_added_to_the_stored_model(spark, tmp_path):
    raw, proc = raw_tables(tmp_path)
    stages.etl(spark, raw, proc)
    first = stages.forecast(spark, proc, f"{tmp_path}/fc", "2024-01-31", 7)
    before = io.read_table(spark, f"{tmp_path}/fc/forecasts").orderBy("date", "warehouse_id").collect()
    again = stages.forecast(spark, proc, f"{tmp_path}/fc", "2024-01-31", 7)          # the same days: nothing changes
    assert again == first and io.read_table(spark, f"{tmp_path}/fc/forecasts").orderBy("date", "warehouse_id").collect() == before
    with open(f"{raw}/sales_history.csv", "a") as f:
        f.write("2024-01-31,W1,A,50,1\n2024-02-01,W1,A,60,1\n")
    stages.etl(spark, raw, proc)
    stages.forecast(spark, proc, f"{tmp_path}/fc", "2024-02-02", 7)
    grown = io.read_table(spark, f"{tmp_path}/fc/forecasts").orderBy("date", "warehouse_id").collect()
    stages.forecast(spark, proc, f"{tmp_path}/fc", "2024-02-02", 7, refit=True)
    assert grown == io.read_table(spark, f"{tmp_path}/fc/forecasts").orderBy("date", "warehouse_id").collect() != before


# --------------------------------------------------------------- versions ----
def numbers(spark, n):
    return spark.range(n).select("id", F.lit("x").alias("v"))


def test_a_write_that_dies_leaves_the_old_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert io.write_table(numbers(spark, 5), path, versioned=True) == 5
    dies = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") == 900, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"),
                                             F.lit("x").alias("v"))
    with pytest.raises(Exception, match="lost"):
        io.write_table(dies, path, versioned=True)
    assert io.read_table(spark, path).count() == 5
    assert io.write_table(numbers(spark, 7), path, versioned=True) == 7 and io.read_table(spark, path).count() == 7


def test_a_table_may_be_replaced_by_what_is_read_of_it(spark, tmp_path):
    path = f"{tmp_path}/t"
    io.write_table(numbers(spark, 5), path, versioned=True)
    begun = io.read_table(spark, path)
    io.write_table(begun.unionByName(begun), path, versioned=True)
    assert io.read_table(spark, path).count() == 10
    assert begun.count() == 5                              # a reader that has begun keeps its version
    for n in (1, 2, 3):
        io.write_table(numbers(spark, n), path, versioned=True)
    assert io.read_table(spark, path).count() == 3 and len(os.listdir(f"{path}/versions")) == io.KEPT
    assert sorted(x for x in os.listdir(path) if not x.startswith(".")) == [io.POINTER, "versions"]


def test_an_empty_table_has_its_schema(spark, tmp_path):
    for versioned in (False, True):
        assert io.write_table(numbers(spark, 0), f"{tmp_path}/{versioned}", versioned=versioned) == 0
        assert io.read_table(spark, f"{tmp_path}/{versioned}").columns == ["id", "v"]
    assert spark.read.parquet(f"{tmp_path}/False").columns == ["id", "v"]      # a plain table is where it was written


# -------------------------------------------------------------- clustered ----
def test_stored_features_need_no_exchange(spark, tmp_path):
    from restock.operators import features as Fe
    from restock.operators import ml, state
    from restock.sources import tpch
    daily = tpch.daily(spark, SF).drop("n_rows")
    path = f"{tmp_path}/it's daily"
    n = io.write_table(daily, path, cluster_by=["warehouse_id", "sku_id"], sort_by=["date"], buckets=4)
    stored = io.read_table(spark, path)
    assert stored.count() == n
    for df in (Fe.rolling_features(stored), ml.chronological_split(stored), state.weekday_sums(stored)):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    plain = io.write_table(daily, f"{tmp_path}/plain")
    assert plain == n and "Exchange" in Fe.rolling_features(io.read_table(spark, f"{tmp_path}/plain"))._jdf.queryExecution().executedPlan().toString()
    # a new version replaces it; a reader of a clustered table that has begun goes on
    io.write_table(stored.where("quantity_sold > 20"), path, cluster_by=["warehouse_id", "sku_id"], buckets=3)
    assert io.read_table(spark, path).count() < n == stored.count()
    with pytest.raises(ValueError):
        io.write_table(daily, f"{tmp_path}/x", fmt="csv", cluster_by=["sku_id"])


# --------------------------------------------------------------- manifest ----
def files_read(df) -> int:
    """Files that the scan of ``versions``-less partitioned tables read, from its metrics."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    todo, out = [plan.finalPhysicalPlan() if "Adaptive" in plan.getClass().getSimpleName() else plan], []
    while todo:
        p = todo.pop()
        if "Scan" in p.getClass().getSimpleName():
            out.append(p.metrics().apply("numFiles").value())
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return max(out)


def test_only_the_newest_plan_is_read(spark, tmp_path):
    day = dt.date(2024, 1, 1)
    rows = [(f"P{i:03d}", day + dt.timedelta(days=i // 2), "a", "b", "s", i, day, day, "Medium", None, 1.0, "r") for i in range(60)]
    plans = spark.createDataFrame(rows, schemas.PLAN).coalesce(1)
    io.write_table(plans, f"{tmp_path}/plans", partition_by=["plan_id"])
    io.write_table(io.manifest_of(plans).coalesce(1), f"{tmp_path}/plans_manifest", partition_by=["plan_id"])
    stored = io.read_table(spark, f"{tmp_path}/plans", schemas.PLAN)
    got = io.newest_by_manifest(stored, io.read_table(spark, f"{tmp_path}/plans_manifest", schemas.MANIFEST))
    assert files_read(got) == 1 and files_read(stored) == 60           # of frames that have not run yet
    assert [(r.plan_id, r.qty) for r in got.collect()] == [("P059", 59)]
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in io.newest_plan(stored).select(*got.columns).collect()]


# ------------------------------------------------------------------ rules ----
def test_planted_duplicates_are_counted(spark):
    inv = spark.createDataFrame([(dt.date(2024, 1, 1), "W", "A", 1, 0, 1)] * 3 + [(dt.date(2024, 1, 2), "W", "A", -1, 0, None),
                                 (None, "W", "A", 1, 0, 1), (None, "W", "A", 1, 0, 1)],
                                "snapshot_date date, warehouse_id string, sku_id string, quantity_on_hand long, quantity_reserved long, quantity_available long")
    pos = spark.createDataFrame([("p", "W", "A"), ("p", "W", "B"), ("q", None, "B")], "po_id string, warehouse_id string, sku_id string")
    got = {(r.table_name, r.rule, r.column_name): (r.checked, r.violations)
           for r in quality.rule_report({"inventory_snapshot": inv, "inbound_pos": pos, "unknown": pos}).collect()}
    assert got["inventory_snapshot", "unique", "snapshot_date,warehouse_id,sku_id"] == (4, 2)
    assert got["inventory_snapshot", "required", "snapshot_date"] == (6, 2)
    assert got["inventory_snapshot", "required", "quantity_available"] == (6, 1)
    assert got["inventory_snapshot", "not_negative", "quantity_on_hand"] == (6, 1)
    assert got["inbound_pos", "unique", "po_id"] == (3, 1) and got["inbound_pos", "required", "warehouse_id"] == (3, 1)
    assert quality.rule_report({"inbound_pos": pos.where("false")}).where("checked > 0 or violations > 0").count() == 0
