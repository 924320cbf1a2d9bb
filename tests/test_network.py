"""Lanes and their costs (C7-C9, H1-H8) on the sf0.001 data."""
import tempfile
import time

from pyspark.sql import functions as F

from restock.operators import network as N
from restock.plans import catalog
from restock.sources import io

SF = "/root/testdata/sf0.001"


def test_lanes_have_no_self_pairs_and_days_multiply(spark):
    m = catalog.Model(spark, SF)
    dm = N.distance_matrix(m.shipments, m.warehouses)
    assert dm.where(F.col("from_wh") == F.col("to_wh")).count() == 0
    assert dm.where(F.col("km") <= 0).count() == 0
    lanes = m.shipments.count()
    assert N.lane_days(m.shipments, m.warehouses, m.skus, "2001-11-05", 14).count() == 14 * lanes
    tc = N.transport_costs(m.shipments, m.warehouses, m.skus)
    assert tc.count() == 8 * lanes
    # expedited doubles the distance part only
    row = (tc.where((F.col("truck_type") == "Large")).groupBy("from_wh", "to_wh", "sku_id")
           .pivot("expedited", [False, True]).agg(F.first("transport_cost"))
           .join(tc.select("from_wh", "to_wh", "sku_id", "km").distinct(), ["from_wh", "to_wh", "sku_id"])
           .first())
    assert abs((row["true"] - row["false"]) - 2.0 * row["km"]) < 1e-6


def test_newest_plan_by_file_time(spark):
    d = tempfile.mkdtemp(prefix="restock-plans-")
    plan = catalog.Model(spark, SF).plan
    io.write_table(plan.withColumn("plan_id", F.lit("OLD")), f"{d}/old")
    time.sleep(1.1)
    io.write_table(plan.withColumn("plan_id", F.lit("NEW")), f"{d}/new")
    both = spark.read.parquet(f"{d}/old", f"{d}/new").select("*", "_metadata.file_modification_time")
    got = io.newest_plan(both, by="file_modification_time").select("plan_id").distinct().collect()
    assert [r[0] for r in got] == ["NEW"]
