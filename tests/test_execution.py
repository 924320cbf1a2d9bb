"""Execution scoring identities."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from restock import schemas
from restock.operators import execution as X


@pytest.fixture(scope="module")
def world(spark):
    whs = spark.createDataFrame(
        [(f"W{i}", "n", None, 40.0, -100.0 + i, 5000.0, None, 1 + i, None, 0.01, 30.0,
          None, None, None, i) for i in range(3)], schemas.WAREHOUSES)
    skus = spark.createDataFrame([("A", "A", "c", 0.01, 1.0, 5.0, None, False, 3),
                                  ("B", "B", "c", 0.01, 1.0, 2.0, 5, False, 3)], schemas.SKUS)
    d = dt.date(2024, 1, 1)
    plan = spark.createDataFrame(
        [("P1", d, "W0", "W1", "A", 100, d, d + dt.timedelta(days=2), "Medium", None, 100.0, "G"),
         ("P1", d, "W0", "W2", "B", 100, d, d + dt.timedelta(days=3), "Medium", None, 100.0, "G"),
         ("P1", d, "W1", "W2", "B", 40, d, d + dt.timedelta(days=3), "Medium", None, 50.0, "G")],
        schemas.PLAN)
    inv = spark.createDataFrame([(d, "W1", "A", 10, 0, 10), (d, "W2", "B", 0, 0, 0)],
                                schemas.INVENTORY_SNAPSHOT)
    lead = spark.createDataFrame([("W1", "A", 9), ("W2", "B", 5)],
                                 "warehouse_id string, sku_id string, actual_lead_time int")
    demand = spark.createDataFrame([("W1", "A", 50.0), ("W2", "B", 400.0)],
                                   "warehouse_id string, sku_id string, actual_demand double")
    fc = spark.createDataFrame([("W1", "A", 50.0), ("W2", "B", 200.0)],
                               "warehouse_id string, sku_id string, forecast double")
    return whs, skus, plan, inv, lead, demand, fc


def test_outcomes_identities(spark, world):
    whs, skus, plan, inv, lead, demand, _ = world
    out = X.transfer_outcomes(plan, whs, skus, lead).toPandas()
    assert (out.actual_qty_received + out.waste_qty == out.planned_qty).all()
    b = out[out.sku_id == "B"].sort_values("planned_qty")
    # ttl 5, lead 5 -> partial waste ratio (5 - 4) / 1 = 1.0 -> int(qty * 1.0)
    assert b.waste_qty.tolist() == [40, 100]
    assert (out.total_cost == out.transport_cost + out.waste_cost).all()


def test_service_and_summary(spark, world):
    whs, skus, plan, inv, lead, demand, _ = world
    out = X.transfer_outcomes(plan, whs, skus, lead)
    svc = X.cell_service(out, inv, demand).toPandas()
    assert ((svc.fulfilled_qty + svc.stockout_qty) - svc.demand).abs().max() < 1e-9
    s = X.execution_summary(out, X.cell_service(out, inv, demand), "2024-01-01").first()
    assert s.total_transfers == 3 and s.total_stockouts == 1
    assert s.overall_service_level == pytest.approx(s.total_fulfilled / s.total_demand)
    long = X.execution_long(X.execution_summary(out, X.cell_service(out, inv, demand), "2024-01-01"),
                            out, X.cell_service(out, inv, demand))
    counts = {r.type: r["count"] for r in long.groupBy("type").count().collect()}
    assert counts == {"SUMMARY": 9, "TRANSFER": 3, "STOCKOUT": 1}
    assert X.report_rows(long, "STOCKOUT").count() == 1


def test_empty_plan_summary(spark, world):
    whs, skus, plan, inv, lead, demand, _ = world
    empty = plan.where(F.lit(False))
    out = X.transfer_outcomes(empty, whs, skus, lead)
    assert X.execution_summary(out, X.cell_service(out, inv, demand), "2024-01-01").count() == 0
    assert out.columns[:4] == ["transfer_id", "from_wh", "to_wh", "sku_id"]


def test_transfer_without_lead_time_row_arrives_as_planned(spark, world):
    whs, skus, plan, inv, lead, demand, _ = world
    out = X.transfer_outcomes(plan, whs, skus, lead.where("warehouse_id = 'W1'")).toPandas()
    assert len(out) == 3
    late = out[out.to_wh == "W2"]
    assert (late.actual_lead_time == late.planned_lead_time).all() and (late.planned_lead_time == 3).all()
