"""The four user stages end to end on CSV inputs."""
import tempfile

from pyspark.sql import functions as F

from restock import schemas
from restock.plans import stages
from restock.sources import io, tpch

SF = "/root/testdata/sf0.001"


def test_stages_on_csv(spark):
    root = tempfile.mkdtemp(prefix="restock-stages-")
    raw, proc, fc, out = (f"{root}/{d}" for d in ("raw", "processed", "forecasts", "plans"))
    # raw inputs as single CSV files in warehouse file order, without source_ord
    wh = tpch.warehouses(spark, SF)
    io.write_table(wh.orderBy("source_ord").drop("source_ord").coalesce(1), f"{raw}/warehouses.csv", "csv")
    io.write_table(tpch.skus(spark, SF).coalesce(1), f"{raw}/skus.csv", "csv")
    io.write_table(tpch.sales_history(spark, SF), f"{raw}/sales_history.csv", "csv")
    io.write_table(tpch.inventory_snapshot(tpch.daily(spark, SF)), f"{raw}/inventory_snapshot.csv", "csv")

    counts = stages.etl(spark, raw, proc)
    assert counts["integrity_report"] == 0 and counts["warehouses"] == 25
    assert "inbound_pos" not in counts                     # optional table skipped
    order = [r.warehouse_id for r in io.read_table(spark, f"{proc}/warehouses")
             .orderBy("source_ord").collect()]
    assert order == sorted(order)                           # file order kept

    f = stages.forecast(spark, proc, fc, "2001-11-05", 14)
    assert f["forecasts"] > 0 and f["models"] == counts["inventory_snapshot"]

    p = stages.optimize(spark, proc, f"{fc}/forecasts", out, "2001-11-05", 14, plan_id="PLAN-T")
    plans = io.read_table(spark, f"{out}/plans")
    assert p["plans"] == plans.count() > 0
    assert plans.where(F.col("explanation_text").startswith("Transfer ")).count() == p["plans"]
    days = io.read_table(spark, f"{out}/ship_days")
    assert days.agg(F.sum("units")).first()[0] == plans.agg(F.sum("qty")).first()[0]
    # a second plan of another method: both are found, the later id is the newest
    p2 = stages.optimize(spark, proc, f"{fc}/forecasts", out, "2001-11-05", 14, method="balanced", plan_id="PLAN-U")
    assert io.read_table(spark, f"{out}/plans").count() == p["plans"] + p2["plans"]

    s = stages.simulate(spark, f"{out}/plans", proc, f"{fc}/forecasts", f"{root}/sim", "2001-11-05", plan_id="PLAN-T")
    assert s["transfers"] == p["plans"]
    s2 = stages.simulate(spark, f"{out}/plans", proc, f"{fc}/forecasts", f"{root}/sim", "2001-11-05")
    assert s2["transfers"] == p2["plans"]
    sim = io.read_table(spark, f"{root}/sim/simulation")
    assert {r.plan_id: r["count"] for r in sim.where(F.col("type") == "SUMMARY").groupBy("plan_id").count().collect()} == {
        "PLAN-T": 9, "PLAN-U": 9}
    short = io.read_table(spark, f"{root}/sim/stockouts")
    assert {"demand", "available_stock", "service_level"} <= set(short.columns) and short.count() == s["stockouts"] + s2["stockouts"]
    # no forecasts at all: the optional source is an empty table with its schema
    empty = io.read_optional(spark, f"{root}/nothing", schemas.FORECASTS)
    assert empty.count() == 0


def test_trees_take_over_where_the_seasonal_model_has_no_row(spark):
    import datetime as dt
    from restock.operators import features as Fe
    d0 = dt.date(2024, 1, 1)
    rows = [(d0 + dt.timedelta(days=i), "W1", "LONG", 20 + 10 * (i % 7 >= 5), 1.0) for i in range(90)]
    rows += [(d0 + dt.timedelta(days=80 + i), "W1", "SHORT", 20 + 10 * ((80 + i) % 7 >= 5), 1.0) for i in range(10)]
    root = tempfile.mkdtemp(prefix="restock-trees-")
    daily = Fe.rolling_features(spark.createDataFrame(
        rows, "date date, warehouse_id string, sku_id string, quantity_sold long, revenue double"))
    io.write_table(daily, f"{root}/proc/daily_sales_aggregated")
    stages.forecast(spark, f"{root}/proc", f"{root}/fc", "2024-03-31", 7)
    got = io.read_table(spark, f"{root}/fc/forecasts").toPandas()
    kind = dict(got.groupby("sku_id").model_type.first())
    assert kind == {"LONG": "trend_weekly", "SHORT": "gbt"} and len(got) == 14
    flat = got[got.sku_id == "SHORT"].sort_values("date")
    truth = [20 + 10 * (i % 7 >= 5) for i in range(90, 97)]
    trees = sum(abs(a - b) for a, b in zip(flat.forecast, truth))
    mean = sum(r[3] for r in rows[-10:]) / 10
    assert trees < sum(abs(mean - b) for b in truth)          # better than the flat mean
