"""Integrity report on hand-made frames (C5, G1, D-3)."""
import datetime as dt

from restock.operators import quality


def test_orphans_counted_per_key(spark):
    d = dt.date(2024, 1, 1)
    sales = spark.createDataFrame(
        [(d, "W1", "A", 1, 1.0), (d, "W9", "A", 1, 1.0), (d, "W9", "Z", 1, 1.0),
         (d, None, "A", 1, 1.0)],
        "date date, warehouse_id string, sku_id string, quantity_sold long, revenue double")
    inv = spark.createDataFrame([(d, "W1", "Z", 1, 0, 1)],
                                "snapshot_date date, warehouse_id string, sku_id string, "
                                "quantity_on_hand long, quantity_reserved long, quantity_available long")
    wh = spark.createDataFrame([("W1",)], "warehouse_id string")
    sk = spark.createDataFrame([("A",)], "sku_id string")
    got = sorted(tuple(r) for r in quality.integrity_report(sales, inv, wh, sk).collect())
    assert got == [("inventory_snapshot", "sku_id", "Z", 1),
                   ("sales_history", "sku_id", "Z", 1),
                   ("sales_history", "warehouse_id", "W9", 2)]
    assert quality.distinct_keys(sales, ["warehouse_id"]).count() == 3
